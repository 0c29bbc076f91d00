import random

import pytest

from llm.helpers import rows
from riskloom.llm import decontamination as dc
from riskloom.llm.common import Words


def greedy(p, t, least):
    """Greedy string tiling as it is defined, by trying every pair of places."""
    free_p, free_t, out = [True] * len(p), [True] * len(t), []
    while True:
        best, spots = 0, []
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and p[i + n] >= 0 and free_p[i + n] and free_t[j + n]:
                    n += 1
                if n > best:
                    best, spots = n, []
                if n == best:
                    spots.append((i, j))
        if best < least:
            return out
        for i, j in spots:
            if all(free_p[i : i + best]) and all(free_t[j : j + best]):
                free_p[i : i + best] = free_t[j : j + best] = [False] * best
                out.append((i, j, best))


def test_tiles_are_greedy():
    random.seed(2)
    for _ in range(1500):
        p = [random.randrange(4) for _ in range(random.randrange(16))]
        t = [random.randrange(-1, 4) for _ in range(random.randrange(28))]
        assert dc.tiles(p, t, 3) == greedy(p, t, 3)


def brute(docs, items, least=5, coverage=0.8):
    out = []
    for d, text in docs:
        t = dc._plain(text).split()
        for i, item in set(items):
            p = dc._plain(item).split()
            number = {w: n for n, w in enumerate(dict.fromkeys(p))}
            found = greedy([number[w] for w in p], [number.get(w, -1) for w in t], min(least, len(p))) if p else []
            n = sum(x for _, _, x in found)
            if p and n >= coverage * len(p):
                out.append((d, i, n / len(p), n, len(p), len(found)))
    return sorted(out, key=str)


@pytest.fixture
def benchmark(spark):
    return lambda *items: spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "'x' as coverage")


def test_small_table(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    found = rows(dc.find_leaks(docs, items))
    near = {r.doc_id: r.text for r in docs.where("n_chars < 3000").collect()}
    expected = brute(list(near.items()), [(r.item_id, r.text) for r in items.collect()])
    assert [r for r in found if r[0] in near] == expected and expected


def passages():
    random.seed(3)
    item = [f"w{i}" for i in range(40)]
    noise = lambda n: [f"n{random.randrange(500)}" for _ in range(n)]
    moved = item[20:] + noise(8) + item[:20]
    shuffled = random.sample(item, 40)
    half = item[:25] + noise(30)
    return " ".join(item), {
        1: " ".join(noise(50) + item + noise(50)), 2: " ".join(noise(9) + moved), 3: " ".join(shuffled), 4: " ".join(half),
        5: ", ".join(w.upper() for w in item) + "!", 6: " ".join(item[:30] + ["x"] + item[31:]), 7: " ".join(item * 400), 8: " ".join(noise(20_000) + item),
    }


def test_reordered_changed_and_partial_passages(documents, benchmark):
    item, docs = passages()
    got = {r[0]: r for r in rows(dc.find_leaks(documents(*docs.items()), benchmark((5, item), (6, "nothing like it at all here"))))}
    assert sorted(got) == [1, 2, 5, 6, 7, 8]
    assert got[2][2:] == (1.0, 40, 40, 2) and got[6][3] == 39
    assert sorted(r.doc_id for r in dc.without_leaks(documents(*docs.items()), benchmark((5, item))).collect()) == [3, 4]


def test_nulls_short_items_and_repeats(documents, benchmark):
    docs = [(None, "a b c d e f g"), (1, None), (2, ""), (3, "x a b c y"), (3, "x a b c y"), (4, "c b a"), (5, "a b c d e")]
    items = [(1, "a b c"), (1, "a b c"), (None, "b c d e f"), (2, None), (3, ""), (4, "?!")]
    assert rows(dc.find_leaks(documents(*docs), benchmark(*items))) == brute(docs, items)
    assert dc.find_leaks(documents(*docs).limit(0), benchmark(*items)).collect() == []
    assert dc.find_leaks(documents(*docs), benchmark(*items).limit(0)).collect() == []
    df = documents(*docs)
    assert dc.without_leaks(df, benchmark((9, "zzz"))).columns == df.columns
    assert dc.without_leaks(df, benchmark(*items).limit(0)).count() == 7


def test_blocks_of_the_benchmark_give_the_same(documents, benchmark):
    random.seed(5)
    docs = [(i, " ".join(random.choice("abcdefgh") for _ in range(60))) for i in range(30)]
    items = [(i, " ".join(random.choice("abcdefgh") for _ in range(random.randrange(1, 12)))) for i in range(40)]
    expected = brute(docs, items)
    assert rows(dc.find_leaks(documents(*docs), benchmark(*items))) == expected
    assert rows(dc.find_leaks(documents(*docs), benchmark(*items), block_words=50)) == expected


def test_a_phrase_of_many_items_costs_no_tiling(spark, documents, monkeypatch):
    phrase = "one phrase that every item has"
    items = [(i, " ".join([*(f"w{i}x{n}" for n in range(10)), phrase, *(f"v{i}x{n}" for n in range(10))])) for i in range(3_000)]
    tried = []
    monkeypatch.setattr(dc, "tiles", lambda *a, real=dc.tiles: tried.append(1) or real(*a))
    known = dc.Items(items, 5)
    texts = [dc._plain(t) for t in [f"{phrase} filler " * 800, f"a {items[7][1]} b {phrase}"]]
    scanned = Words(texts)
    assert list(known.covered(scanned, scanned.hashes(), 0.8)) == [(1, 7, 26, 1)] and len(tried) == 1


def test_slices_of_postings_change_nothing(spark, documents, monkeypatch):
    draw = random.Random(5)
    items = [(i, " ".join(draw.choice("abcd") for _ in range(12))) for i in range(60)]
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.randrange(0, 200))) for _ in range(40)]
    known, scanned = dc.Items(items, 5), Words([t.encode() for t in texts])
    whole = sorted(known.covered(scanned, scanned.hashes(), 0.5))
    monkeypatch.setattr(dc, "POSTINGS", 7)
    assert whole and sorted(known.covered(scanned, scanned.hashes(), 0.5)) == whole
    every = {(t, i): n for t, i, n, _ in known.covered(scanned, scanned.hashes(), 0.0)}
    assert {(t, i) for t, i, n, _ in whole if n >= 6} == {p for p, n in every.items() if n >= 6}

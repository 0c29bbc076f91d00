import random
import re
from collections import Counter, defaultdict

import pytest
from llm.helpers import rows
from riskloom.llm import collocations as co

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, least=100, best=2000, share=100):
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^ \t]+", piece)
            n[lang] += len(ws)
            f.update((lang, *ws[i:j]) for i in range(len(ws)) for j in range(i + 1, min(i + 5, len(ws)) + 1))
    longer = defaultdict(int)
    for (lang, *ws), c in f.items():
        if c >= least:
            for i in range(len(ws)):
                for j in range(i + 2, len(ws) + 1):
                    if j - i < len(ws):
                        longer[(lang, *ws[i:j])] = max(longer[(lang, *ws[i:j])], c)
    found = defaultdict(list)
    for (lang, *ws), a in f.items():
        if len(ws) < 2 or a < least or 100 * longer[(lang, *ws)] >= share * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *ws[:k])] * f[(lang, *ws[k:])]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(ws).encode(), f[(lang, *ws[:k])], f[(lang, *ws[k:])]))
    return sorted(
        ((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, x in found.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:best])), key=str
    )


def frame(spark, docs):
    return spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 as w1", "'x' as slot", "2 as n", "3 as k", "4 as f", "5 as rank")


@pytest.mark.parametrize("least", [100, 25])
def test_small_table(spark, small, least):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ours = rows(co.collocations(docs, least))
    assert ours and ours == brute([(r.lang, r.text) for r in docs.collect()], least)


def test_pieces_ties_repeats_nulls_and_long_text(spark):
    random.seed(3)
    some = ["A b", "a b c", "é x", "b", "c  d\te", "a b c d e f", "x.y z", "\x0bq", "b\x85c"]
    docs = [(random.choice(["en", None, "und", ""]), random.choice([". ", " ", "\n", ", "]).join(random.choices(some, k=random.randrange(40)))) for _ in range(300)]
    docs += [("en", None), ("en", ""), ("fr", None), ("fr", " \t ")] + [("de", "aa aa aa aa aa aa aa")] * 50
    docs += [("long", " ".join(random.choices(["one", "two", "three"], k=300_000)))]
    for least, best, share in ((100, 2000, 100), (20, 7, 100), (5, 2000, 40)):
        ours = rows(co.collocations(frame(spark, docs).repartition(5), least, best, share))
        assert ours == brute(docs, least, best, share)


def test_empty_table_and_shared_slots(spark, monkeypatch):
    assert co.collocations(frame(spark, [("en", "a b")]).limit(0)).collect() == []
    docs = [("en", " ".join(f"w{(i * i + j) % 17}" for j in range(30))) for i in range(40)]
    expected = brute(docs, 30)
    monkeypatch.setattr(co, "SLOTS", (64, 64, 64, 64))
    monkeypatch.setattr(co, "HELD_ROWS", 50)
    assert rows(co.collocations(frame(spark, docs), 30)) == expected


def test_score_is_exact(spark):
    counts = [(9 * 10**12, 2 * 10**14, 10**13, 3 * 10**13), (123456789012, 987654321098765, 123456789013, 223456789012), (99999999999999, 99999999999999999, 99999999999999, 99999999999998), (100, 1000, 150, 170)]
    df = spark.createDataFrame(counts, "a long, n long, l long, r long").selectExpr("a", "n", "l", "r", f"{co.SCORE} as score")
    assert [r.score for r in df.collect()] == [1000 * a * n // (l * r) for a, n, l, r in counts]


def test_rare_phrases_add_up_to_no_window(spark, monkeypatch):
    """in a corpus with many more pairs than bits, windows still end where no frequent phrase goes on."""
    monkeypatch.setattr(co, "SLOTS", (1 << 10, 1 << 10, 1 << 10, 1 << 10))
    common = [f"c{i}" for i in range(150)]
    random.seed(5)
    docs = [("en", " ".join(random.choices(common, k=3_000)) + ". " + "to be or not " * 2) for _ in range(60)]
    made = []
    counted = co._counted_windows
    chunk = co.Chunk(co.pa.RecordBatch.from_pydict({"lang": [x for x, _ in docs], "text": [x for _, x in docs]}))
    bitmaps = []
    for width in range(1, 5):  # as phrase_counts makes them
        slots, n = co.np.unique(chunk.slots(width)[chunk.hopeful(width, bitmaps)], return_counts=True)
        frame_ = spark.createDataFrame([(int(s),) for s in co._as_int(slots[n >= 100]).to_pylist()], "slot int")
        bitmaps.append(co._bitmap(frame_, co.SLOTS[width - 1]))
    assert counted(chunk, bitmaps).num_rows < 500  # 180,000 words of 150 kinds; before, most pairs went on
    assert rows(co.collocations(frame(spark, docs), 100)) == brute(docs)


def test_words_counted_once_make_no_window(spark):
    """A frequent word that leads no frequent pair is counted with the words, not again as a window."""
    random.seed(7)
    common = [f"c{i}" for i in range(300)]
    docs = [("en" if i % 2 else None, " ".join(random.choices(common, k=2_000)) + ". to be or not. to be") for i in range(120)]
    chunk = co.Chunk(co.pa.RecordBatch.from_pydict({"lang": [x or "und" for x, _ in docs], "text": [x for _, x in docs]}))
    met = spark.createDataFrame([(x, w) for x in ("en", "und") for w in [*common, "to", "be"]], "lang string, word string")
    bitmaps = [co._bitmap(met.mapInArrow(co._word_slots, "slot int"), co.SLOTS[0])]
    assert chunk.frequent(1, bitmaps).sum() == 120 * 2_004  # slots of words are those of runs of one word
    slots, n = co.np.unique(chunk.slots(2)[chunk.hopeful(2, bitmaps)], return_counts=True)
    pairs = spark.createDataFrame([(int(s),) for s in co._as_int(slots[n >= 60]).to_pylist()], "slot int")
    bitmaps.append(co._bitmap(pairs, co.SLOTS[1]))
    made = co._counted_windows(chunk, bitmaps)
    assert made.num_rows < 20 and made["w2"].null_count == 0  # before, 600 windows of one word
    assert rows(co.collocations(frame(spark, docs), 60)) == brute(docs, 60)

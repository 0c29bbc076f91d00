import hashlib
import random

import numpy as np

from llm.helpers import rows, words
from riskloom.llm import substring_dedup as sd
from riskloom.llm.common import Words


def brute(docs, window):
    first, out = {}, []
    for d, text in sorted(docs, key=lambda r: r[0]):
        w = words(text)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    for d, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (d, i):
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 20)
    assert rows(sd.dedup_substrings(docs, with_text=False)) == expected
    assert sum(r[2] for r in expected) > 0


def test_random_texts_with_few_words(documents):
    random.seed(3)
    docs = [(i, random.choice([" ", "\t", " \n "]).join(random.choice("abc") for _ in range(random.randrange(30)))) for i in range(60)]
    assert rows(sd.dedup_substrings(documents(*docs), 4, with_text=False)) == brute(docs, 4)


def test_windows_without_rare_words(documents, monkeypatch):
    """Two words make every triple common; windows then go by their own hash to many buckets."""
    monkeypatch.setattr(sd, "BUCKET_WORDS", 3)
    random.seed(5)
    docs = [(i, " ".join(random.choice("ab") for _ in range(random.randrange(200)))) for i in range(40)]
    docs += [(100 + i, "a " * 90) for i in range(20)]
    found = sd.repeated_ranges(documents(*docs), 6)
    assert found.count() and rows(sd.dedup_substrings(documents(*docs), 6, with_text=False)) == brute(docs, 6)


def test_a_phrase_in_most_documents(documents):
    random.seed(4)
    phrase = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"a{i} b{i} {phrase} c{random.randrange(9)} {phrase}") for i in range(80)]
    assert rows(sd.dedup_substrings(documents(*docs), with_text=False)) == brute(docs, 20)


def test_nulls_empty_repeated_and_long(documents):
    long = " ".join(f"w{i % 700}" for i in range(40_000))
    text = " ".join(f"v{i}" for i in range(25))
    docs = documents((None, text), (1, None), (2, ""), (3, "  \n\t"), (4, text), (4, text), (5, text), (6, long), (7, "é ü 日本 " * 12))
    got = sorted((r.doc_id is not None, r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in sd.dedup_substrings(docs).collect())
    by = {}
    for _, d, n, gone, kept in got:
        by.setdefault(d, []).append((n, gone, kept))
    assert by[None] == [(25, 0, text)]
    assert by[1] == by[2] == by[3] == [(0, 0, "")]
    assert by[4] == [(25, 0, text)] * 2  # one document given twice
    assert by[5] == [(25, 25, "")]
    assert by[6][0][:2] == (40_000, 40_000 - 700)  # after one round every window has come before
    assert by[7][0][0] == 36


def test_empty_table(documents, spark):
    assert sd.dedup_substrings(documents((1, "a")).limit(0)).collect() == []


def test_equal_hashes_are_compared_in_full(monkeypatch):
    texts = [b" ".join(b"%d" % (i + k) for i in range(6)) for k in (0, 1, 0)]
    places = np.asarray([[1, 0, 0], [2, 0, 0], [3, 0, 0]])
    monkeypatch.setattr(Words, "hashes", lambda self: np.ones(self.n, dtype=np.uint64))
    assert sd._later_windows(texts, places, 4).tolist() == [[2, 0, 0, 5], [3, 0, 0, 6]]


def test_words_are_those_of_the_pattern():
    texts = [b"", b" a  b\x0b\x0cc ", None, "ü x y\x1f".encode(), b"\x1c"]
    w = Words(texts)
    got = [[w.buf[w.start[i] : w.end[i]] for i in range(a, b)] for a, b in zip(w.first, w.first[1:])]
    assert got == [words((t or b"").decode()) for t in texts]

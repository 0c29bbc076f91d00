import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm.helpers import rows, words
from riskloom.llm import simhash_dedup as sh
from riskloom.llm.components import local_components, stars


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lower)
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    n = len(prints)
    pairs = [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    a, b = (np.asarray([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
    return local_components(n, a, b)


def brute(docs):
    prints = [fingerprint(t) for _, t in docs]
    label = linked(prints)
    least = {}
    for (d, _), x in zip(docs, label):
        least[x] = min([i for i in (least.get(x), d) if i is not None], default=None)
    return sorted(((d, f"{p:016x}", least[x]) for (d, _), p, x in zip(docs, prints, label)), key=str)


def test_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert rows(sh.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def near_copies(n):
    random.seed(8)
    base = [f"w{random.randrange(400)}" for _ in range(200)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(random.randrange(4)):
            w[random.randrange(200)] = f"x{random.randrange(9)}"
        out.append((i, " ".join(w)))
    return out


def test_chains_of_near_copies(documents):
    docs = near_copies(150)
    assert rows(sh.near_duplicates(documents(*docs))) == brute(docs)


def test_nulls_short_repeated_and_long(documents):
    docs = [(None, "lone text of its own"), (None, "a b c"), (7, "A B c"), (3, "a  b\tc"), (9, None), (8, ""), (4, " \n"), (5, "one"), (6, "one two"), (2, "É e f"), (1, "é e f"), (11, "long text " * 30_000), (11, "long text " * 30_000), (11, "other words here")]
    assert rows(sh.near_duplicates(documents(*docs))) == brute(docs)
    kept = [(r.doc_id, r.text) for r in sh.keep_one(documents(*docs)).collect()]
    assert sorted(kept, key=str) == sorted([(None, "lone text of its own"), (3, "a  b\tc"), (4, " \n"), (5, "one"), (6, "one two"), (2, "É e f"), (1, "é e f"), (11, "long text " * 30_000), (11, "other words here")], key=str)


def test_keep_one_keeps_all_columns(documents):
    df = documents((1, "a b c d"), (2, "a b c d"), (3, "z y x w"))
    kept = sh.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_empty_table(documents):
    assert sh.near_duplicates(documents((1, "a")).limit(0)).collect() == []
    assert sh.keep_one(documents((1, "a")).limit(0)).collect() == []


def test_large_groups_are_cut_again():
    rng = np.random.default_rng(0)
    for n, most in ((2500, 6), (2500, 8)):
        x = np.unique(np.asarray([0x123456789ABCDEF0 ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, most), replace=False)) for _ in range(n)], dtype=np.uint64))
        a, b = sh.link_group(x, 3, 0, 64)
        i, j = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
        assert len(x) > sh.SMALL_GROUP and len(a) < len(x)
        assert (local_components(len(x), a, b) == local_components(len(x), i, j)).all()


def test_other_bit_distances(spark):
    random.seed(9)
    prints = sorted({0xF0F0F0F0F0F0F0F ^ sum(1 << random.randrange(64) for _ in range(random.randrange(6))) for _ in range(120)})
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for bits in (0, 1, 2, 5):
        got = stars(sh.near_links(df, bits)).collect()
        place = {(p - (1 << 64) if p >> 63 else p): i for i, p in enumerate(prints)}
        pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits]
        expected = local_components(len(prints), *(np.asarray([p[k] for p in pairs], dtype=np.int64) for k in (0, 1)))
        mine = local_components(len(prints), *(np.asarray([place[r[k]] for r in got], dtype=np.int64) for k in ("u", "v")))
        assert (mine == expected).all()


def test_stars_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    assert sorted(map(tuple, stars(path).collect())) == [*((i, 0) for i in range(1, 61)), (101, 100)]


def test_a_hot_fingerprint_meets_its_label_in_many_tasks(spark, documents):
    docs = documents(*[(i, "" if i % 3 else f"text number {i} of its own") for i in range(300)], (None, ""), (7, ""))
    prints = sh.fingerprints(docs, 3)
    label = prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("component_id"))
    got = sh._labelled(prints, label)
    assert sorted(map(str, got.select(*prints.columns).collect())) == sorted(map(str, prints.collect()))
    assert got.where("n > 100").select("salt").distinct().count() > 32
    one = {r.fp: r.component_id for r in label.collect()}
    assert all(r.component_id == one[r.fp] for r in got.collect())

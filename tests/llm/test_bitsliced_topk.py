import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import rows
from riskloom.llm import bitsliced_topk as bt


def brute(vectors, k=5, every=50):
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if i % every == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def frame(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("key", "v", "slot", "ids", "score", "rank")})


def test_small_table(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    assert rows(bt.top_k(vectors)) == brute([(r.vec_id, r.embedding) for r in vectors.collect()])


def test_ties_repeats_nulls_and_odd_lengths(spark):
    random.seed(5)
    vectors = [(i, [random.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for i in range(150)]
    vectors += [(i, [0.5, 0.5, 0.5]) for i in range(150, 200)] + [(50, [9.0, -9.0, 1.0]), (7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0])]
    vectors += [(None, [1.0] * 3), (300, None), (301, [None, 1.0, 1.0]), (350, [float("nan"), 1.0, 1.0]), (351, [float("inf"), 1.0, 1.0])]
    vectors += [(400, []), (401, []), (450, [0.1, 0.2]), (500, [0.5] * 7), (501, [0.25] * 7)]
    assert rows(bt.top_k(frame(spark, vectors))) == brute(vectors)


def test_small_blocks_give_the_same(spark, monkeypatch):
    random.seed(6)
    vectors = frame(spark, [(i, [random.uniform(-2, 2) for _ in range(5)]) for i in range(230)])
    expected = rows(bt.top_k(vectors))
    monkeypatch.setattr(bt, "QUERY_BLOCK", 2)
    monkeypatch.setattr(bt, "GROUP_BYTES", 100)
    queries = bt.quantised(vectors.where("vec_id % 50 = 0"))
    assert rows(bt.search(bt.build_index(vectors, block_rows=32), queries)) == expected


def test_empty_table_and_too_large(spark):
    assert bt.top_k(frame(spark, [(1, [1.0])]).limit(0)).collect() == []
    with pytest.raises(Exception, match="fit a long"):
        bt.top_k(frame(spark, [(0, [1e9]), (1, [1e9])])).collect()


def test_score_slices_add_up():
    rng = np.random.default_rng(1)
    values, query = rng.integers(0, 500, (100, 9)), rng.integers(-300, 300, 9)
    plane = (values.T[:, None, :] >> np.arange(9)[:, None]) & 1
    wide = np.concatenate([plane, np.zeros((9, 9, 28), dtype=plane.dtype)], axis=2).astype(np.uint8)
    score, constant = bt.score_slices(np.packbits(wide, axis=2, bitorder="little").view("<u8"), query)
    bits = [np.unpackbits(s.view(np.uint8), bitorder="little")[:100].astype(np.int64) for s in score]
    assert (sum(b << i for i, b in enumerate(bits)) + constant == values @ query).all()

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import multi_index as mi


def brute(vectors, k=10, every=100):
    """{(query, vector): [(distance, vec_id)]}, all candidates in order, and the first k."""
    good = [(i, np.asarray(v, dtype=np.float64)) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % every == 0:
            out[i, tuple(v)] = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != i and len(w) == len(v))[:k]
    return out


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>").withColumns({c: F.lit(1) for c in ("x", "code", "dims", "cell", "part", "salt", "query", "rank", "label")})


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def close(a, b):
    return len(a) == len(b) and all(i == j and abs(x - y) < 1e-12 for (x, i), (y, j) in zip(a, b))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    truth = brute([(r.vec_id, r.embedding) for r in vectors.collect()])
    ours = results(mi.nearest(vectors))
    assert set(ours) == {q for q, _ in truth} and all(len(v) == 10 for v in ours.values())
    hits = [len({j for _, j in t} & {j for _, j in ours[q]}) for (q, _), t in truth.items()]
    assert sum(hits) >= 0.9 * 10 * len(hits)
    exact = {q: dict((j, d) for d, j in t) for (q, _), t in truth.items()}
    assert all(abs(exact[q][j] - d) < 1e-12 for q, v in ours.items() for d, j in v if j in exact[q])


def test_everything_within_the_radius(spark, monkeypatch):
    monkeypatch.setattr(mi, "CELL_ROWS", 20)  # many cells, and salted ones
    monkeypatch.setattr(mi, "QUERY_ROWS", 3)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    x = np.concatenate([c + s * rng.normal(size=(70, 8)) for c, s in zip(centres, (0.01, 0.1, 0.3, 0.5, 1, 2))]).astype(np.float32)
    index = mi.build_index(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), 10)
    assert index.prefix >= 4 and index.cells.where("salts > 1").count()
    code = index.codes.of(8).codes(x.astype(np.float64)).view(np.uint64)
    apart = mi.hamming(code, code)
    for radius in (0, 3, 9, 14, 22, 30, 64):
        queries = spark.createDataFrame([(q, 1, int(code[q].view(np.int64)), 8, x[q].tolist(), radius) for q in range(0, 420, 30)], "query long, qkey long, code long, dims int, x array<float>, radius int")
        ours = {}
        for r in sorted(mi.within(index, queries, 10).collect(), key=lambda r: (r.query, r.rank)):
            ours.setdefault(r.query, []).append((r.dist, r.vec_id))
        for q in range(0, 420, 30):
            d = np.sqrt(((x[q].astype(np.float64) - x) ** 2).sum(1))
            assert close(ours.get(q, []), sorted((float(d[j]), j) for j in range(420) if j != q and apart[q, j] <= radius)[:10])


def test_shares_meet_the_radius():
    for radius in range(mi.BITS + 1):
        t = mi.shares(radius)
        assert mi.WIDTH in t or sum(s + 1 for s in t) == radius + 1


@pytest.mark.parametrize("kind", ["float", "double"])
def test_copies_ties_nulls_and_odd_lengths(spark, kind):
    random.seed(8)
    vectors = [(i, [random.choice([-1.0, 0.5, 0.0, 1.0]) for _ in range(4)]) for i in range(250)]
    vectors += [(i, [0.5, 0.5, -0.0, 1.0]) for i in range(300, 420)] + [(300, [2.0, 0.0, 0.0, 0.0]), (7, [0.5, 0.5, 0.0, 1.0]), (7, [0.5, 0.5, 0.0, 1.0])]
    vectors += [(None, [1.0] * 4), (500, None), (600, [None, 1.0, 1.0, 1.0]), (700, [float("nan")] * 4), (701, [float("inf"), 1.0, 1.0, 1.0]), (800, [0.0] * 4), (900, [])]
    vectors += [(1000, [0.25] * 2), (1001, [0.5] * 2), (1002, [1.0, 0.0]), (1100, [3.0])]
    ours = mi.nearest(frame(spark, vectors, kind)).collect()
    got = sorted((r.query_id, r.rank, r.score, r.vec_id) for r in ours)
    expected = sorted((q, n + 1, d, j) for (q, _), t in brute(vectors).items() for n, (d, j) in enumerate(t))
    assert [(a, b, d) for a, b, _, d in got] == [(a, b, d) for a, b, _, d in expected]
    assert np.allclose([c for *_, c, _ in got], [c for *_, c, _ in expected], rtol=0, atol=1e-12)


def test_empty_table(spark):
    assert mi.nearest(frame(spark, [(0, [1.0])]).limit(0)).collect() == []
    assert mi.nearest(frame(spark, [(0, [1.0])])).collect() == []

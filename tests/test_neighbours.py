import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import neighbours


def brute(x, ids, grp, k):
    out = set()
    for i in range(len(x)):
        others = [j for j in range(len(x)) if j != i and grp[j] == grp[i]]
        dist = np.zeros(len(others))
        for d in range(x.shape[1]):
            dist += (x[i, d] - x[others, d]) ** 2
        order = sorted(range(len(others)), key=lambda n: (dist[n], ids[others[n]]))[:k]
        out |= {(grp[i], ids[i], p + 1, ids[others[n]]) for p, n in enumerate(order)}
    return out


def found(spark, x, ids, grp, k):
    rows = [(int(g), int(i), [float(v) for v in r]) for g, i, r in zip(grp, ids, x)]
    points = spark.createDataFrame(rows, "grp int, id bigint, x array<double>")
    return [tuple(r) for r in neighbours.nearest(points, k).collect()]


@pytest.fixture
def small(monkeypatch):
    """Many cells, and shelves and visits that must be cut."""
    for name, value in (("CELL_ROWS", 12), ("LEAST_SHELF_ROWS", 30), ("SHELF_ROWS", 30), ("VISITORS", 40), ("STEP", 16)):
        monkeypatch.setattr(neighbours, name, value)


@pytest.mark.parametrize("kind", ["spread", "clusters", "grid", "copies", "far", "zero"])
def test_equals_brute_force(spark, small, kind):
    draw = np.random.default_rng(3)
    n = 300
    x = draw.normal(0, 1, (n, 4))
    if kind == "clusters":
        x = x * 0.01 + draw.integers(0, 6, (n, 1)) * 10
    if kind == "grid":  # many equal distances
        x = draw.integers(0, 4, (n, 4)).astype(float)
    if kind == "copies":  # one point with a third of the rows, another with fewer than k
        x[:100], x[100:103] = x[0], x[100]
    if kind == "far":  # rounding: small distances between large numbers
        x = x * 1e-3 + 1e6
    if kind == "zero":
        x[:] = 0.0
    ids, grp = draw.permutation(n) * 7, draw.integers(0, 2, n)
    got = found(spark, x, ids, grp, 5)
    assert len(got) == len(set(got)) and set(got) == brute(x, ids, grp, 5)


def test_small_groups_and_no_rows(spark):
    x, ids, grp = np.array([[0.0], [1.0], [3.0], [9.0], [9.0]]), [5, 6, 7, 8, 9], [0, 0, 0, 1, 1]
    assert set(found(spark, x, ids, grp, 4)) == brute(x, ids, grp, 4)
    assert found(spark, x[:1], ids[:1], grp[:1], 3) == []
    assert found(spark, x[:0], [], [], 3) == []


def test_far_cells_are_not_visited(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    monkeypatch.setattr(neighbours, "LEAST_SHELF_ROWS", 60)
    visits = []
    searched = neighbours._searched
    monkeypatch.setattr(neighbours, "_searched", lambda b, *a: visits.append(b.agg(F.sum(F.size("shelves"))).first()[0]) or searched(b, *a))
    draw = np.random.default_rng(1)
    for n in (2_000, 4_000):
        found(spark, draw.uniform(0, 1, (n, 2)), range(n), [0] * n, 3)
    assert visits[1] < 2.6 * visits[0] < 2.6 * 2_000 * 8


@pytest.mark.parametrize("far, single", [(0.0, True), (1e3, True), (1e9, False)])
def test_a_visit_in_single_precision_misses_none(far, single):
    draw = np.random.default_rng(7)
    y, x = draw.normal(far, 1, (500, 6)), draw.normal(far, 1, (90, 6))
    y[40], y[60:90] = x[0], y[20]  # copies
    if not single:
        y[:250] -= far  # the shelf is so wide that single precision can't tell
    others, ids = np.arange(500), np.arange(500, 590)
    exact = ((x[:, None] - y[None]) ** 2).sum(2)
    nearest = np.sort(exact, axis=1)[:, 2]
    visit = neighbours.Shelf(y, others).visit(ids, x, np.sqrt(nearest), 3)
    assert visit.y.dtype == (np.float32 if single else np.float64)
    for at in range(0, 500, 128):
        visit.meet(np.arange(90), slice(at, min(at + 128, 500)))
    kept = set(zip(*visit.candidates()))
    assert {(r, c) for r, c in zip(*np.nonzero(exact <= nearest[:, None]))} <= kept
    assert not single or len(kept) < 2 * 90 * (3 + 30)


def test_comparing_with_many_cells_holds_little():
    import tracemalloc

    draw = np.random.default_rng(8)
    pivot = draw.normal(size=(4_096, 8))
    cells = neighbours.Cells(np.zeros(4_096, dtype=int), pivot, float((pivot**2).sum(1).max()))
    x = draw.normal(size=(1_024, 8))
    tracemalloc.start()
    placed = cells.place(0, x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (placed == ((x[:, None] - pivot[None]) ** 2).sum(2).argmin(1)).all()
    assert peak < 5 * 8 * neighbours.ROOM

"""Steps mended for size: rows settled before the fits, rounding without text, visits of shelves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import neighbours, prepare
from riskloom.plans import queries


@pytest.mark.parametrize("places", [2, 4, 6, 10])
def test_rounding_is_that_of_spark_to_the_bit(spark, places):
    r = np.random.default_rng(places)
    ties = (r.integers(-(10**8), 10**8, 2_000) * 2 + 1) / (2 * 10**places)
    values = np.concatenate([
        ties, np.nextafter(ties, np.inf), np.nextafter(ties, -np.inf), r.normal(size=2_000) * 1e5, r.integers(-99, 99, 2_000) / 7,
        10 ** r.uniform(-12, 20, 2_000), [0.0, -0.0, np.nan, np.inf, -np.inf, 1e308, 5e-324, -1e-9],
    ])
    x = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    differ = ~queries.rounded(F.col("x"), places).eqNullSafe(F.round("x", places))
    assert x.where(differ).count() == 0


@pytest.mark.parametrize("name", ["standardize", "minmax_scale"])
def test_scaled_rows_come_from_settled_ones(spark, name):
    plan = queries.registry()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_preparation_joins_the_raw_table_once(spark, monkeypatch):
    asked = []
    for step in ("stratified_split", "fit_fill", "packed"):
        def seen(df, *args, _run=getattr(prepare, step), **named):
            asked.append("Join" in df._jdf.queryExecution().optimizedPlan().toString())
            return _run(df, *args, **named)
        monkeypatch.setattr(prepare, step, seen)
    prepare.prepare(queries._raw(spark, "/root/testdata/sf0.001"), queries.PARAMS)
    assert asked == [False] * 3


@pytest.mark.parametrize("grid", [None, 3])
def test_a_visit_keeps_few_candidates_and_all_that_matter(grid):
    r = np.random.default_rng(5)
    y, k, step = r.normal(size=(6_000, 8)), 4, 500
    if grid:  # many equal distances
        y = np.round(y * grid) / grid
    others = r.permutation(len(y))
    x, ids = y[:300], others[:300]
    visit = neighbours.Shelf(y, others).visit(ids, x, np.full(300, np.inf), k)
    for at in range(0, len(y), step):
        visit.meet(np.arange(300), slice(at, at + step))
    row, col = visit.candidates()
    found = neighbours._first(row, col, neighbours._exact(x[row], y[col]), others[col], k)
    wanted = neighbours.closest(ids, x, others, y, k)
    assert all((a == b).all() for a, b in zip(found, wanted))
    assert grid or len(row) == 300 * k

"""Cases that once gave wrong answers, and work that once ran twice."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import Params
from riskloom import catalog as cat
from riskloom.operators import eda, evaluate, models, prepare, resample
from riskloom.plans import queries
from conftest import SMALL


@pytest.mark.parametrize("label, area", [(0, 0.5), (1, 1.0)])
def test_area_of_a_single_class(spark, label, area):
    rows = spark.createDataFrame([("m", label, s / 10) for s in range(10)] + [("other", i % 2, float(i % 2)) for i in range(4)], "model string, label int, score double")
    got = {r["model"]: r["pr_auc"] for r in evaluate.pr_auc(rows, ["model"]).collect()}
    assert got == pytest.approx({"m": area, "other": 1.0})


def test_quantile_points_of_decimals(spark):
    values = [Decimal("1.50"), Decimal("1.75"), Decimal("2.25"), None]
    rows = spark.createDataFrame([(v,) for v in values], "x decimal(10, 2)")
    got = eda.qq_points(rows, ["x"]).orderBy("place").collect()
    assert [r["ordered"] for r in got] == [1.5, 1.75, 2.25]


@pytest.mark.parametrize("few", [1, 5])
def test_too_few_rows_to_synthesize(spark, few):
    rows = [(i, 0 if i < few else 1, [float(i), 0.0]) for i in range(few + 20)]
    points = spark.createDataFrame(rows, "id bigint, Target int, x array<double>")
    with pytest.raises(ValueError, match="6 rows"):
        resample.smote(points, k=5)


def test_queries_leave_no_table_behind(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("credit_features")
    try:
        for name in ("scan_table", "sink_table", "scan_colmap_table"):
            assert queries.registry()[name](spark, SMALL).count() > 0
        assert [t.name for t in spark.catalog.listTables() if not t.isTemporary] == ["credit_features"]
        assert spark.table("credit_features").count() == 3
    finally:
        spark.sql("drop table credit_features")


def test_centres_are_a_fixed_point():
    draw = np.random.default_rng(3)
    x = np.concatenate([draw.normal(c, 0.3, (60, 4)) for c in range(5)])
    centres = resample._lloyd(x, 5)
    own = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert np.allclose(centres, [x[own == c].mean(0) for c in range(5)])


def test_one_cell_or_several_are_close(spark):
    draw = np.random.default_rng(4)
    x = np.concatenate([draw.normal(0, 1, (40, 2)), *[draw.normal(4 * c, 0.3, (100, 2)) for c in range(1, 5)]])
    points = spark.createDataFrame([(i, int(i >= 40), [float(v) for v in r]) for i, r in enumerate(x)], "id bigint, Target int, x array<double>")

    def inertia(cell_rows):
        centres = np.array([r["x"] for r in resample.undersample_centroids(points, cell_rows=cell_rows).collect()])
        assert len(centres) == 40
        return ((x[40:, None] - centres[None]) ** 2).sum(2).min(1).sum()

    whole = inertia(400)
    assert inertia(399) < 1.5 * whole and inertia(120) < 1.5 * whole


def test_scores_come_from_rows_not_fitted(spark, raw):
    train = prepare.prepare(raw, Params()).train.select(cat.KEY, "Target", "fold", "pca")
    fitted = models.search("SVM", train, Params(fourier_size=16), {"C": (1.0,), "kernel": ("linear", "rbf")})
    assert len(fitted.cv) == 2 and len(fitted.model.curve) == 2
    scored = fitted.predict(train)
    assert scored.where("score between 0 and 1").count() == train.count()


def test_forest_is_searched_and_the_best_of_two_is_taken(spark, raw):
    train = prepare.prepare(raw, Params()).train.select(cat.KEY, "Target", "fold", "pca")
    a, b = (models.search("RandomForest", train, Params(), {"n_estimators": (n,), "max_depth": (3,)}) for n in (2, 10))
    best = models.best_of([a, b])
    assert len(best.cv) == 2 and best.cv[[a, b].index(max((a, b), key=lambda f: f.cv[0][1]))][0] == best.best


def test_spread_runs_nothing(spark):
    from riskloom.session import spread

    shuffled = spark.range(100).groupBy((F.col("id") % 7).alias("id")).count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "")
    spread(shuffled, "id")
    assert list(tracker.getJobIdsForGroup("spread")) == []


def test_distances_of_blocks_are_summed_in_pieces():
    import tracemalloc

    draw = np.random.default_rng(9)
    x, y = draw.normal(size=(700, 5)), draw.normal(size=(333, 5))
    y[:40] = x[:40]

    def total(a, b):
        return np.sqrt(((a[:, None] - b[None]) ** 2).sum(2)).sum()

    assert np.isclose(resample._pair_total(x, y, False), 2 * total(x, y), rtol=1e-7)
    assert np.isclose(resample._pair_total(x, x, True), total(x, x), rtol=1e-12)
    wide = draw.normal(size=(2_048, 20))
    tracemalloc.start()
    resample._pair_total(wide, wide, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20

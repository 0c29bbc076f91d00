import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom import Params
from riskloom import catalog as cat
from riskloom.operators import models, prepare, resample


@pytest.fixture(scope="module")
def ready(raw):
    return prepare.prepare(raw, Params())


def vectors(df, name):
    rows = df.orderBy(cat.KEY).select(vector_to_array(name).alias("x"), "Target").collect()
    return np.array([r["x"] for r in rows]), np.array([r["Target"] for r in rows])


def test_split_is_exact_and_complete(raw):
    table = prepare.encode(raw).table.select(cat.KEY, "Target")
    split = prepare.stratified_split(table)
    got = {(r["Target"], r["part"]): r["count"] for r in split.groupBy("Target", "part").count().collect()}
    for c in (0, 1):
        size = got[c, "train"] + got[c, "test"]
        assert got[c, "test"] == int(size * 0.2 + 0.5)
    assert sum(got.values()) == raw.count()
    moved = prepare.stratified_split(table.repartition(11))
    assert split.exceptAll(moved).count() == 0


def test_single_class_splits(spark):
    df = spark.range(10).select(F.col("id").alias(cat.KEY), F.lit(1).alias("Target"))
    assert prepare.stratified_split(df).where("part = 'test'").count() == 2


def test_folds_differ_by_one_row(ready):
    counts = ready.train.groupBy("Target", "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in counts if r["Target"] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_scaled_train_rows(ready):
    x, _ = vectors(ready.train, "scaled")
    assert np.allclose(x.mean(0), 0, atol=1e-9)
    assert np.allclose(np.where(x.std(0) > 0.5, x.std(0), 1.0), 1.0, atol=1e-9)


def test_components_match_a_dense_solution(ready):
    x, _ = vectors(ready.train, "scaled")
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(ready.components.ratios, values / values.sum(), atol=1e-9)
    total = np.cumsum(values / values.sum())
    assert ready.kept == int(np.argmax(total >= 0.95)) + 1
    scores, _ = vectors(ready.train, "pca")
    assert scores.shape[1] == ready.kept
    covariance = np.cov(scores.T)
    assert np.allclose(covariance, np.diag(np.diag(covariance)), atol=1e-8)
    assert np.allclose(np.diag(covariance), values[: ready.kept], atol=1e-8)


def test_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5)], "a double, b int")
    for fit, a in ((prepare.fit_standard, [-1.0, 1.0]), (prepare.fit_minmax, [0.0, 1.0])):
        rows = fit(df, ["a", "b"]).transform(df).orderBy("a").collect()
        assert [r["a"] for r in rows] == a and [r["b"] for r in rows] == [0.0, 0.0]


def cloud(spark, few=70, many=150, width=3, copies=0, seed=5):
    draw = np.random.default_rng(seed)
    x = draw.normal(0, 1, (few + many, width))
    if copies:
        x[:copies] = x[0]
    rows = [(i, 0 if i < few else 1, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, Target int, x array<double>"), x


@pytest.mark.parametrize("copies", [0, 40])
def test_nearest_matches_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(resample, "BLOCK_ROWS", 16)
    points, x = cloud(spark, copies=copies)
    few = points.where("Target = 0").select(F.lit(0).alias("grp"), "id", "x")
    got = {}
    for r in resample.nearest(few, 5).collect():
        got.setdefault(r["id"], {})[r["place"]] = r["neighbour"]
    a = x[:70]
    for i in range(70):
        dist = np.zeros(70)
        for d in range(a.shape[1]):
            dist += (a[i, d] - a[:, d]) ** 2
        order = [j for j in np.lexsort((np.arange(70), dist)) if j != i][:5]
        assert [got[i][p] for p in range(1, 6)] == order


def test_mean_distance_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_ROWS", 16)
    points, x = cloud(spark)
    few = points.where("Target = 0").select(F.lit(0).alias("grp"), "id", "x")
    a = x[:70]
    full = np.sqrt(((a[:, None] - a[None]) ** 2).sum(2))
    row = resample.mean_distance(few).first()
    assert row["rows"] == 70 and np.isclose(row["mean_distance"], full.sum() / (70 * 69))


def test_mean_distance_moves_a_row_once(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_ROWS", 8)
    monkeypatch.setattr(resample, "RUN_BLOCKS", 3)
    draw = np.random.default_rng(8)
    x = draw.normal(size=(130, 3))
    points = spark.createDataFrame([(int(i >= 90), i, [float(v) for v in r]) for i, r in enumerate(x)] + [(2, 900, [0.0, 1.0, 2.0])], "grp int, id bigint, x array<double>")
    blocks = resample._packed_blocks(points)
    assert blocks.agg(F.sum("n")).first()[0] == 131 and "Cartesian" in resample.mean_distance(points)._jdf.queryExecution().toString()
    got = {r["grp"]: (r["rows"], r["mean_distance"]) for r in resample.mean_distance(points).collect()}
    for g, a in ((0, x[:90]), (1, x[90:])):
        full = np.sqrt(((a[:, None] - a[None]) ** 2).sum(2)).sum()
        assert got[g][0] == len(a) and np.isclose(got[g][1], full / (len(a) * (len(a) - 1)))
    assert got[2] == (1, 0.0)


def test_smote_rows_lie_on_segments(spark):
    points, x = cloud(spark)
    made = resample.smote(points, k=5).collect()
    assert len(made) == 80 and {r["Target"] for r in made} == {0}
    a = x[:70]
    for r in made:
        p, v = np.array(r["x"]), a[r["id"]]
        on = [
            np.linalg.norm(np.cross(p - v, w - v)) < 1e-9 and -1e-9 <= (p - v) @ (w - v) <= (w - v) @ (w - v) + 1e-9
            for w in np.delete(a, r["id"], 0)
        ]
        assert any(on)
    per_base = np.bincount([r["id"] for r in made], minlength=70)
    assert per_base.min() >= 1 and per_base.max() <= 2


def test_cluster_smote_fills_the_gap(spark):
    points, _ = cloud(spark)
    vectored = points.withColumn("v", array_to_vector("x"))
    made = resample.cluster_smote(vectored, "v", clusters=3, threshold=0.01)
    assert made.count() == 80


@pytest.mark.parametrize("copies", [0, 120])
def test_centroids_number_as_the_minority(spark, monkeypatch, copies):
    monkeypatch.setattr(resample, "CELL_ROWS", 20)
    points, x = cloud(spark, few=150, many=70, copies=copies)
    made = resample.undersample_centroids(points).collect()
    assert len(made) == 70
    centres = np.array([r["x"] for r in made])
    assert (centres.min(0) >= x[:150].min(0) - 1e-9).all() and (centres.max(0) <= x[:150].max(0) + 1e-9).all()


def test_one_class_cannot_be_rebalanced(spark):
    points, _ = cloud(spark)
    with pytest.raises(ValueError):
        resample.smote(points.where("Target = 0"))


def test_largest_remainders():
    assert resample.largest_remainders(10, [1, 1, 1]) == [4, 3, 3]
    assert sum(resample.largest_remainders(7, [0.2, 5.1, 0.05])) == 7


@pytest.mark.parametrize(
    "name, point",
    [
        ("LogisticRegression", {"C": 0.1}),
        ("RandomForest", {"n_estimators": 10, "max_depth": 5}),
        ("SVM", {"C": 1.0, "kernel": "rbf"}),
    ],
)
def test_models_beat_the_no_skill_rate(ready, name, point):
    fitted = models.fit(name, ready.train, Params(), **point)
    scored = models.predictions([fitted], ready.test).persist()
    assert scored.where("score between 0 and 1").count() == ready.test.count()
    summary = models.model_summary([fitted], scored).first()
    base = scored.agg(F.avg("label")).first()[0]
    assert summary["pr_auc"] > base


def test_search_reports_every_grid_point(ready):
    fitted = models.search("LogisticRegression", ready.train, Params(folds=5), {"C": (0.01, 1.0)})
    assert len(fitted.cv) == 2 and fitted.best["C"] == max(fitted.cv, key=lambda c: c[1])[0]["C"]


def test_the_leak_shows(raw, ready):
    leaky = prepare.prepare(raw, Params(leak_guard=False))
    scores = {}
    for kind, data in (("guarded", ready), ("leaky", leaky)):
        fitted = models.fit("LogisticRegression", data.train, Params(), C=0.1)
        scores[kind] = models.model_summary([fitted], fitted.predict(data.test)).first()["f1"]
    assert scores["leaky"] > scores["guarded"]


def test_cosine_features_approximate_the_kernel(spark, ready):
    x, _ = vectors(ready.train.limit(60), "pca")
    z = models.fit_fourier(ready.train.select(vector_to_array("pca").alias("x")), size=8000)(x)
    everything, _ = vectors(ready.train, "pca")
    gamma = 1 / (x.shape[1] * everything.var())
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(z @ z.T - kernel).max() < 0.08

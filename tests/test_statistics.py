import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom import catalog as cat
from riskloom.functions.hashing import hash_key, hash_uniform
from riskloom.functions.normal import inverse_normal
from riskloom.operators import eda, evaluate, ordering, quantiles
from riskloom.operators.moments import correlations

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_inverse_normal(spark):
    rows = spark.createDataFrame([(0.001,), (0.5,), (0.975,), (0.9999,)], "p double").select(
        inverse_normal(F.col("p")).alias("z")
    ).collect()
    assert np.allclose([r["z"] for r in rows], [-3.090232306, 0.0, 1.959963985, 3.719016485], atol=1e-8)


@pytest.mark.parametrize("held", [1_000_000, 10])
def test_quantiles_match_numpy(spark, held):
    draw = np.random.default_rng(1)
    x = np.concatenate([draw.lognormal(3, 2, 6000), np.full(3000, 7.5), draw.normal(0, 1, 1000)])
    df = spark.createDataFrame([(float(v), "ab"[i % 3 == 0]) for i, v in enumerate(x)], "v double, g string")
    got = quantiles.numeric_summary(df.repartition(7), ["v"], ["g"], accuracy=500, held=held).collect()
    for row in got:
        part = np.array([v for i, v in enumerate(x) if "ab"[i % 3 == 0] == row["g"]])
        assert np.allclose(row["quantiles"], np.quantile(part, [0.25, 0.5, 0.75]), rtol=1e-12)
        assert row["n"] == len(part) and np.isclose(row["std"], part.std(ddof=1))


@SLOW
@given(st.lists(st.integers(-200_000, 200_000), min_size=1, max_size=60))
def test_running_sums(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    counts = ordering.with_bucket(ordering.value_counts(df, [], "v"), "v")
    got = {r["v"]: r["upto"] for r in ordering.running_sums(counts, [], "bucket", "v", {"upto": "n"}).collect()}
    assert got == {v: sum(w <= v for w in values) for v in values}


def test_fraction_buckets_keep_order(spark):
    df = spark.range(2000).select((F.col("id") / 7.0).alias("v"), F.lit(1).cast("bigint").alias("n"))
    cut = ordering.with_bucket(df, "v")
    assert cut.select("bucket").distinct().count() > 10
    got = ordering.running_sums(cut, [], "bucket", "v", {"upto": "n"}).orderBy("v").collect()
    assert [r["upto"] for r in got] == list(range(1, 2001))


@SLOW
@given(st.lists(st.one_of(st.floats(allow_nan=False), st.floats(0.999999, 1.0)), min_size=1, max_size=60), st.booleans())
def test_running_sums_of_any_doubles(spark, values, descending):
    values = sorted({v + 0.0 for v in values} | {0.0, 5e-324, -5e-324, float("inf"), -float("inf"), 1.0, 1.0 - 2**-53})
    df = spark.createDataFrame([(v, i + 1) for i, v in enumerate(values)], "v double, n bigint")
    cut = ordering.with_bucket(df, "v")
    assert [r["bucket"] for r in cut.orderBy("v").collect()] == sorted(r["bucket"] for r in cut.collect())
    got = {r["v"]: r["upto"] for r in ordering.running_sums(cut, [], "bucket", "v", {"upto": "n"}, descending).collect()}
    sign = -1 if descending else 1
    assert got == {v: sum(i + 1 for i, w in enumerate(values) if sign * w <= sign * v) for v in values}


def test_nan_comes_last(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (0.5,)], "v double")
    assert [str(r["v"]) for r in ordering.with_bucket(df, "v").orderBy("bucket").collect()] == ["0.5", "inf", "nan"]


def test_buckets_start_no_job(spark, monkeypatch):
    from pyspark.sql import DataFrame

    for action in ("count", "collect", "first", "toPandas"):
        monkeypatch.setattr(DataFrame, action, lambda *a: pytest.fail("a job at build"))
    ordering.with_bucket(spark.range(9).selectExpr("id / 7.0D as v"), "v")


@pytest.mark.parametrize("ordered", [100_000, 3])
def test_hash_cuts_are_exact(spark, monkeypatch, ordered):
    monkeypatch.setattr(ordering, "HASH_ORDERED_ROWS", ordered)
    monkeypatch.setattr(ordering, "HASH_STEP_DIGITS", 1)
    df = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("int").alias("g"))
    digest = hash_key(7, "t", F.col("id"))
    ranks = [lambda n, g: 0, lambda n, g: 17, lambda n, g: int(n * 0.5 + 0.5)]
    cuts = ordering.fit_hash_cuts(df, "g", digest, ranks)
    got = {(r["g"], r["c"]): r["count"] for r in df.withColumn("c", cuts.above(digest)).groupBy("g", "c").count().collect()}
    assert got == {
        (0, 1): 17, (0, 2): 1650, (0, 3): 1666, (1, 1): 17, (1, 2): 817, (1, 3): 833,
    }


def test_hash_uniform_is_uniform(spark):
    u = [r[0] for r in spark.range(4000).select(hash_uniform(1, "u", F.col("id"))).collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(np.mean(u) - 0.5) < 0.02


def test_correlations_with_missing_values(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(1000, 1, (600, 3))
    x[:, 1] += 0.5 * x[:, 0]
    x[draw.random((600, 3)) < 0.2] = np.nan
    rows = [(*[None if np.isnan(v) else float(v) for v in r], 5.0) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {(r["i"], r["j"]): r["r"] for r in correlations(df, ["a", "b", "c", "d"]).collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert np.isclose(got[i, j], np.corrcoef(x[both, i], x[both, j])[0, 1], atol=1e-9)
    assert got[0, 3] is None


def test_describe_keeps_empty_columns(spark):
    df = spark.createDataFrame([(None, 1), (None, 0)], "age_under_25 int, n int")
    rows = {r["feature"]: r for r in eda.describe_numeric(df, ["age_under_25", "n"]).collect()}
    assert rows["age_under_25"]["count"] == 0 and rows["age_under_25"]["mean"] is None
    assert rows["n"]["q50"] == 0.5


def test_density_integrates_to_one(raw):
    rows = eda.kde_by_class(raw).groupBy("feature", "risk").agg(
        (F.sum("density") * (F.max("x") - F.min("x")) / 199).alias("area")
    ).collect()
    assert len(rows) == 6 and all(abs(r["area"] - 1) < 0.005 for r in rows)


def test_density_matches_brute_force(spark, applications):
    rng = np.random.default_rng(3)
    # a broad body, a far outlier and a mass of equal values
    values = [*rng.integers(250, 9000, 300).tolist(), 40_000, *[1500] * 200]
    rows = [{cat.LABEL: 1, "Credit_amount": v} for v in values] + [{cat.LABEL: 2, "Credit_amount": 7}] * 3
    df = applications(*rows, {cat.LABEL: 1, "Credit_amount": None})
    got = eda.kde_by_class(df, ["Credit_amount"]).orderBy("point").collect()
    x = np.asarray(values, dtype=float)
    h = x.std(ddof=1) * len(x) ** -0.2
    at = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 200)
    full = np.exp(-0.5 * ((at[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert len(got) == 200 and len({r["risk"] for r in got}) == 1  # equal values have no bandwidth
    assert np.allclose([r["x"] for r in got], at)
    assert np.abs(np.asarray([r["density"] for r in got]) - full).max() < 1e-13 * full.max()


def test_density_spreads_cells_not_values(spark, raw):
    many = raw.sparkSession.range(0, 400_000, 1, 8).selectExpr("cast(id as int) as v", "cast(1 + id % 2 as int) as label")
    df = many.selectExpr(f"label as `{cat.LABEL}`", "v as `Credit_amount`")
    curve = eda.kde_by_class(df, ["Credit_amount"])
    assert curve.count() == 400
    text = curve._jdf.queryExecution().executedPlan().toString()
    assert "cell" in text and "CartesianProduct" not in text


def test_qq_runs_split_hot_values(spark, monkeypatch, raw):
    whole = eda.qq_points(raw).orderBy("feature", "place").collect()
    monkeypatch.setattr(eda, "QQ_CHUNK", 7)
    assert eda.qq_points(raw).orderBy("feature", "place").collect() == whole


def test_results_do_not_depend_on_layout(raw):
    apart = raw.repartition(13, cat.LABEL)
    for build in (eda.box_stats, eda.kde_by_class, eda.qq_points):
        a = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in build(raw).collect())
        b = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in build(apart).collect())
        assert a == b


def test_group_names(spark):
    names = ["chk_none", "hist_critical", "Credit Amount (DM)", "Personal Status & Sex_m_single"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(eda.group_name(F.col("n"))).collect()] == [
        "Checking", "Credit History", "Other", "Sex",
    ]


# Published test scores and the counts they follow from.
PUBLISHED = {
    "LogisticRegression": ((131, 3, 9, 57), 0.9562043795620438, 0.9776119402985075, 0.9357142857142857),
    "RandomForest": ((134, 9, 6, 51), 0.9469964664310954, 0.9370629370629371, 0.9571428571428572),
    "SVM": ((137, 5, 3, 55), 0.9716312056737588, 0.9647887323943662, 0.9785714285714285),
}


def test_published_scores_follow_from_their_counts(spark):
    rows = [
        (m, *cell)
        for m, ((tp, fp, fn, tn), *_) in PUBLISHED.items()
        for cell in ((1, 1, tp), (0, 1, fp), (1, 0, fn), (0, 0, tn))
    ]
    counts = spark.createDataFrame(rows, "model string, actual int, predicted int, n bigint")
    for r in evaluate.scores_from_counts(counts, ["model"]).collect():
        assert (r["f1"], r["precision"], r["recall"]) == pytest.approx(PUBLISHED[r["model"]][1:], rel=1e-15)


def test_pr_curve_with_a_mixed_top_score(spark):
    df = spark.createDataFrame(
        [(0, 0.9), (1, 0.9), (1, 0.5), (0, 0.2)], "label int, score double"
    ).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    assert evaluate.pr_auc(df).first()[0] == pytest.approx(2 / 3)
    curve = {(r["precision"], r["recall"]) for r in evaluate.pr_curve(df).collect()}
    assert curve == {(1.0, 0.0), (0.5, 0.5), (2 / 3, 1.0), (0.5, 1.0)}


def test_measures_by_model(spark):
    one = spark.createDataFrame(
        [("a", 1, 1, 0.9), ("a", 0, 0, 0.1), ("b", 1, 0, 0.2), ("b", 0, 1, 0.8)],
        "model string, label int, prediction int, score double",
    )
    f1 = {r["model"]: r["f1"] for r in evaluate.metrics_prf(one, ["model"]).collect()}
    auc = {r["model"]: r["pr_auc"] for r in evaluate.pr_auc(one, ["model"]).collect()}
    assert f1 == {"a": 1.0, "b": 0.0} and auc["a"] == 1.0 and auc["b"] == pytest.approx(0.25)

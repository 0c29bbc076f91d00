"""What the physical plans and the sources must not contain."""

import pathlib
import re

import pytest
from conftest import SMALL

from riskloom.operators import eda, features, ordering, prepare
from riskloom.plans.queries import registry
from riskloom.session import spread
from riskloom.sources.sample import sample_applications


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_view_is_one_projection(spark, raw):
    source = raw.sparkSession.createDataFrame([], raw.schema)
    text = plan(features.feature_view(source))
    assert "Exchange" not in text and "Python" not in text and "ArrowEval" not in text


def test_scans_read_only_what_is_used(spark):
    text = plan(registry()["ratio_safe"](spark, SMALL))
    assert "o_orderdate" not in text and "o_orderpriority" not in text


@pytest.mark.parametrize("name", ["kde_by_class", "qq_normal", "box_stats", "category_risk_counts", "stratified_split"])
def test_no_single_task_sort(name, spark):
    text = plan(registry()[name](spark, SMALL))
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text


def test_split_adds_no_shuffle(spark):
    rows = spark.range(1000).selectExpr("id as application_id", "int(id % 3 = 0) as Target")
    text = plan(prepare.stratified_folds(prepare.stratified_split(rows)))
    assert "Exchange" not in text and "Join" not in text


def test_large_input_is_not_moved(spark):
    rows = spark.range(0, 100, 1, 64)
    assert "Exchange" not in plan(spread(rows, "id"))
    assert spread(rows.coalesce(1), "id").rdd.getNumPartitions() == 8


def test_running_sums_move_rows_once(spark, raw):
    counts = ordering.with_bucket(
        ordering.value_counts(raw.select("Credit_amount"), [], "Credit_amount"), "Credit_amount"
    )
    sums = ordering.running_sums(counts, [], "bucket", "Credit_amount", {"upto": "n"})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(sums)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the only unpartitioned step is over bucket totals, after their aggregation
    for match in re.finditer(r"Exchange SinglePartition.*\n.*\n?", text):
        assert "HashAggregate" in match.group(0) or "Project" in match.group(0)


def test_sources_stay_distributed():
    package = pathlib.Path(__file__).parent.parent / "riskloom"
    for path in package.rglob("*.py"):
        text = path.read_text()
        for word in ("toPandas", "localCheckpoint", "crossJoin", "F.rand(", "@F.udf", "collect_set"):
            assert word not in text, (path, word)


def test_skewed_customers_keep_every_row(spark):
    whole = sample_applications(spark, SMALL)
    assert whole.count() == spark.read.parquet(f"{SMALL}/orders.parquet").count()
    assert eda.class_balance(whole).agg({"n": "sum"}).first()[0] == whole.count()

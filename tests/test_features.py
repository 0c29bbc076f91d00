import pytest
from pyspark.sql import functions as F

from riskloom import catalog as cat
from riskloom.operators import features, prepare
from riskloom.plans import etl
from riskloom.session import scratch_path
from riskloom.sources import readers, writers
from riskloom.streaming.etl import run_available


def test_catalog_shape():
    names = cat.display_names()
    assert len(names) == len(set(names.values())) == 95
    assert len(cat.RAW_ORDER) == 21 and len(cat.FLAGS) == 59


def test_view_width_and_names(raw):
    view = features.feature_view(raw, keep=())
    assert len(view.columns) == len(set(view.columns)) == 98
    assert set(view.columns) - {cat.repeat_name(c) for c in cat.REPEATED} == set(cat.display_names())


def test_missing_and_unlisted_codes(applications):
    rows = features.feature_view(
        applications(
            {},
            {"Savings_account_bonds": "A65", "Property": "A124", "Purpose": "A999"},
        )
    ).collect()
    for a in cat.ATTRIBUTES:
        assert rows[0][a.decoded] == "unknown"
        assert all(rows[0][flag] is None for _, _, flag, _ in a.codes)
    listed = rows[1]
    assert listed["savings_desc"] == "unknown" and listed["sav_unknown"] == 1
    assert listed["property_desc"] == "unknown" and listed["prop_unknown"] == 1
    assert listed["purpose_desc"] == "unknown" and listed["pur_car_new"] == 0


@pytest.mark.parametrize("duration, expected", [(0, None), (None, None), (1, 100.0), (8, 12.5)])
def test_monthly_amount(applications, duration, expected):
    row = features.feature_view(applications({cat.DURATION: duration, cat.AMOUNT: 100})).first()
    assert row[cat.RATIO] == expected


@pytest.mark.parametrize(
    "age, group, flags",
    [
        (24, "Under_25", (1, 0, 0)), (25, "25_to_40", (0, 1, 0)), (40, "25_to_40", (0, 1, 0)),
        (41, "Over_40", (0, 0, 1)), (None, "Over_40", (None, None, None)),
    ],
)
def test_age(applications, age, group, flags):
    row = features.feature_view(applications({cat.AGE: age})).first()
    assert row[cat.AGE_GROUP] == group and tuple(row[f] for f in cat.AGE_FLAGS) == flags


def test_target_and_sex(spark):
    df = spark.createDataFrame(
        [(1, "m_single"), (2, "f_single"), (3, "unknown"), (None, "Male")],
        f"{cat.LABEL} int, status_sex_desc string",
    )
    rows = features.with_sex(features.with_target(df)).collect()
    assert [r["Target"] for r in rows] == [1, 0, None, None]
    assert [r["Sex"] for r in rows] == [1, 0, 0, 1]


def test_one_hot_drops_first_and_leaves_missing_zero(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, x string")
    rows = {r["id"]: (r["x_b"], r["x_c"]) for r in features.one_hot(df, ["x"]).collect()}
    assert rows == {1: (1, 0), 2: (0, 0), 3: (0, 0), 4: (0, 1)}


def test_too_many_categories_stop_the_job(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("x"))
    with pytest.raises(ValueError):
        features.categories(df, ["x"], limit=49)


def test_csv_missing_and_quoting(spark):
    df = spark.createDataFrame(
        [(1, "none", 5), (2, None, None), (3, "a,b \"c\"", 7)], "k int, t string, n int"
    )
    path = scratch_path(spark, "csv")
    writers.write_csv(df, path)
    assert sorted(readers.read_csv(spark, path, df.schema).collect()) == sorted(df.collect())
    spark.createDataFrame([("k,t,n",), ("4,,",), ("5,None,None",)], "value string").coalesce(1).write.text(path + "x")
    rows = readers.read_csv(spark, path + "x", df.schema).collect()
    assert [tuple(r) for r in rows] == [(4, None, None), (5, None, None)]


def test_etl_and_stream_agree(spark, raw):
    path = scratch_path(spark, "etl")
    view = etl.run(raw, path, keep=(cat.KEY,))
    batch = readers.read_csv(spark, path, view.schema)
    source = scratch_path(spark, "source")
    raw.write.parquet(source)
    sink = scratch_path(spark, "sink")
    run_available(spark, source, sink, scratch_path(spark, "checkpoint")).awaitTermination()
    streamed = spark.read.parquet(sink).select(*view.columns)
    assert batch.exceptAll(streamed).count() == 0 and streamed.count() == batch.count()


def test_leak_guard(raw):
    guarded = prepare.encode(raw).inputs
    assert len(guarded) == 68
    assert not any(c.startswith("risk") or c == cat.LABEL for c in guarded)
    open_ = prepare.encode(raw, leak_guard=False).inputs
    assert cat.LABEL in open_ and "risk_Good" in open_

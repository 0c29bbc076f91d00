"""Exact summaries with interpolated quantiles, sized for tables of any length.

The built-in exact percentile keeps every distinct value of a group in one task. It is
used only where a first pass has shown that the values are few. For the other columns a
sketch with a guaranteed rank error brackets each quantile, and only values inside a
bracket are ordered, in up to 4,096 slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.codes import q
from riskloom.operators.ordering import running_sums

QUARTILES = (0.25, 0.5, 0.75)
SLICES = 4_096
# distinct values of one group that may be held together
HELD_VALUES = 1_000_000


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows of (by, feature, value double), without missing values."""
    narrow = df.select(*[q(b) for b in by], *[q(c).cast("double").alias(c) for c in columns])
    return narrow.unpivot(
        [q(b) for b in by], [q(c) for c in columns], "feature", "value"
    ).where(F.col("value").isNotNull() & ~F.isnan("value"))


def numeric_summary(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
    probs: Sequence[float] = QUARTILES, accuracy: int = 10_000, held: int = HELD_VALUES,
) -> DataFrame:
    """Per (by, feature): n, mean, std, low, high and ``quantiles`` in order of ``probs``.

    ``by`` columns must have few values, such as a class label. Two passes: statistics and
    sketches first, whose result is one row per group, then the exact quantiles.
    """
    keys = [*by, "feature"]
    rows = long_form(df, columns, by)
    slack = 5.0 / accuracy
    below = [max(p - slack, 0.0) for p in probs]
    above = [min(p + slack, 1.0) for p in probs]
    groups = rows.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.percentile_approx("value", [*below, *above], accuracy).alias("sketch"),
    ).collect()
    whole = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}

    def few(group) -> bool:
        # integers between two bounds have at most that many distinct values
        return group["n"] <= held or (
            group["feature"] in whole and group["high"] - group["low"] < held
        )

    spark = df.sparkSession
    key_type = [rows.schema[k] for k in keys]
    stats = spark.createDataFrame(
        [tuple(g[k] for k in [*keys, "n", "mean", "std", "low", "high"]) for g in groups],
        T.StructType(
            [*key_type, T.StructField("n", T.LongType())]
            + [T.StructField(c, T.DoubleType()) for c in ("mean", "std", "low", "high")]
        ),
    )
    parts = []
    small = sorted({g["feature"] for g in groups} - {g["feature"] for g in groups if not few(g)})
    if small:
        parts.append(
            rows.where(F.col("feature").isin(small))
            .groupBy(*keys)
            .agg(F.percentile("value", F.array(*[F.lit(float(p)) for p in probs])).alias("quantiles"))
        )
    large = [g for g in groups if g["feature"] not in small]
    if large:
        brackets = []
        for g in large:
            for i, p in enumerate(probs):
                tight = g["n"] * slack > 10
                lo = g["sketch"][i] if tight and below[i] > 0 else g["low"]
                hi = g["sketch"][len(probs) + i] if tight and above[i] < 1 else g["high"]
                at = (g["n"] - 1) * p
                brackets.append((*[g[k] for k in keys], i, lo, hi, int(at), at - int(at)))
        parts.append(
            _bracketed(
                rows.where(F.col("feature").isin(sorted({g["feature"] for g in large}))),
                keys,
                spark.createDataFrame(
                    brackets,
                    T.StructType(
                        [*key_type, T.StructField("prob", T.IntegerType()),
                         T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()),
                         T.StructField("place", T.LongType()), T.StructField("share", T.DoubleType())]
                    ),
                ),
            )
        )
    if not parts:
        return stats.withColumn("quantiles", F.lit(None).cast("array<double>"))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found.join(F.broadcast(stats), keys).select(*keys, "n", "mean", "std", "low", "high", "quantiles")


def _bracketed(rows: DataFrame, keys: list[str], brackets: DataFrame) -> DataFrame:
    """Quantiles of ``rows`` from the values inside the brackets.

    One pass counts the rows below each bracket and the values in it, combined before the
    shuffle. The brackets number one per group and probability and are broadcast.
    """
    inside = F.col("value") >= F.col("lo")
    width = F.col("hi") - F.col("lo")
    cut = F.when(width > 0, F.floor((F.col("value") - F.col("lo")) / width * SLICES)).otherwise(0)
    counted = (
        rows.join(F.broadcast(brackets), keys)
        .where("value <= hi")
        .groupBy(
            *keys, "prob", "place", "share",
            F.when(inside, F.least(cut, F.lit(SLICES - 1))).otherwise(-1).cast("bigint").alias("slice"),
            F.when(inside, F.col("value")).alias("value"),
        )
        .agg(F.count("*").alias("n"))
    )
    group = [*keys, "prob", "place", "share"]
    placed = running_sums(counted, group, "slice", "value", {"upto": "n"})

    def value_at(rank: Column) -> Column:
        hit = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(hit, F.col("value")))

    place = F.col("place")
    ends = placed.groupBy(*group).agg(
        value_at(place).alias("a"),
        value_at(place + (F.col("share") > 0).cast("int")).alias("b"),
    )
    exact = F.col("a") + (F.col("b") - F.col("a")) * F.col("share")
    # the sketch error is a guarantee; were it ever exceeded, stop instead of guessing
    checked = F.when(exact.isNull(), F.raise_error(F.lit("quantile outside its bracket"))).otherwise(exact)
    return ends.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("prob", checked.alias("x")))), lambda s: s["x"]
        ).alias("quantiles")
    )

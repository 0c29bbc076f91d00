"""Measures of scored rows: (label, prediction, score), label 1 being the wanted class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import running_sums, with_bucket


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(actual, predicted, n) over the full 2 x 2 grid, from one row per group."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counts = df.groupBy(*by).agg(
        *[
            F.count_if((F.col("label") == a) & (F.col("prediction") == p)).alias(f"n{a}{p}")
            for a, p in cells
        ]
    )
    grid = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n{a}{p}").alias("n"))
            for a, p in cells
        ]
    )
    return counts.select(*by, F.inline(grid))


def scores_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(precision, recall, f1) of class 1 from confusion rows; an empty ratio is 0."""
    def cell(actual: int, predicted: int):
        hit = (F.col("actual") == actual) & (F.col("predicted") == predicted)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).cast("double")

    sums = counts.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn")
    )

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        *by,
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def metrics_prf(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scores_from_counts(confusion_matrix(df, by), by)


def _counts_by_score(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Positives and negatives at or above every distinct score."""
    tallies = df.groupBy(*by, "score").agg(
        F.sum("label").cast("bigint").alias("hits"),
        F.sum(1 - F.col("label")).cast("bigint").alias("misses"),
    )
    placed = running_sums(
        with_bucket(tallies, "score"), by, "bucket", "score",
        {"tp": "hits", "fp": "misses"}, descending=True,
    )
    totals = df.groupBy(*by).agg(F.sum("label").cast("bigint").alias("positives"))
    if by:
        return placed.join(F.broadcast(totals), list(by))  # one row per model
    return placed.withColumn("positives", totals.scalar())


def pr_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point (1, 0)."""
    placed = _counts_by_score(df, by)
    tp, fp = F.col("tp").cast("double"), F.col("fp")
    curve = placed.select(
        *by, F.col("score").alias("threshold"), (tp / (tp + fp)).alias("precision"),
        F.when(F.col("positives") > 0, tp / F.col("positives")).otherwise(1.0).alias("recall"),
    )
    ends = df.groupBy(*by).agg(F.count("*").alias("rows")).where("rows > 0").select(
        *by, F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(ends)


def pr_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The trapezoid area under the curve that starts at precision 1.

    The point before a score follows from the running sums without that score's own rows,
    so no further ordering is needed.
    """
    placed = _counts_by_score(df, by)
    tp, fp = F.col("tp").cast("double"), F.col("fp")
    tp0, fp0 = tp - F.col("hits"), fp - F.col("misses")
    precision = tp / (tp + fp)
    before = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(1.0)
    # without positives recall is 1 from the first score on, as in the curve
    first = F.when(tp0 + fp0 == 0, 1.0).otherwise(0.0)
    gained = F.when(F.col("positives") > 0, F.try_divide(F.col("hits"), F.col("positives"))).otherwise(first)
    area = gained * (precision + before) / 2.0
    return placed.groupBy(*by).agg(F.sum(area).alias("pr_auc"))


def no_skill_rate(df: DataFrame, label: str = "label") -> DataFrame:
    """The share of positives: the precision of guessing."""
    return df.agg(F.avg(label).alias("no_skill"))

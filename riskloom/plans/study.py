"""The whole study: statistics, model inputs, searched models and the report tables."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import catalog as cat
from riskloom.operators import eda, evaluate, features, models, prepare, resample
from riskloom.params import Params
from riskloom.session import drop_scratch, tune
from riskloom.sources import readers, writers


def statistics(raw: DataFrame, params: Params) -> dict[str, DataFrame]:
    """Every statistics table, lazily planned."""
    view = features.feature_view(raw)
    numbers = [c for c in features.numeric_columns(view) if c != cat.KEY and not c.endswith(":1")]
    correlated, names = eda.correlation_inputs(raw)
    return {
        "describe": eda.describe_numeric(view, numbers),
        "class_balance": eda.class_balance(raw),
        "category_counts": eda.category_counts(view),
        "category_percent": eda.category_percent(view),
        "corr_matrix": eda.corr_matrix(correlated, names, params.top_correlations),
        "top_correlations": eda.in_group_order(
            eda.strongest(eda.corr_to_target(correlated, names), params.top_correlations)
        ),
        "box_stats": eda.box_stats(raw),
        "box_outliers": eda.box_outliers(raw),
        "kde": eda.kde_by_class(raw),
        "qq_points": eda.qq_points(raw),
        "qq_fit": eda.qq_line(eda.qq_points(raw)),
    }


def preparation(ready: prepare.Prepared, params: Params, resampled: bool = True) -> dict[str, DataFrame]:
    """Split counts, explained variance, the first two components and the resamplers' counts."""
    spark = ready.train.sparkSession
    parts = [df.select("Target", F.lit(p).alias("part")) for p, df in (("train", ready.train), ("test", ready.test))]
    scores = vector_to_array("pca")
    found = {
        "split_counts": eda.class_balance(parts[0].unionByName(parts[1]), "Target", ["part"]),
        "explained_variance": prepare.cumulative_variance(spark, ready.components).withColumn(
            "kept", F.col("component") <= ready.kept
        ),
        "projection_2d": ready.train.select(cat.KEY, "Target", F.get(scores, F.lit(0)).alias("pc1"), F.get(scores, F.lit(1)).alias("pc2")),
    }
    if resampled:
        points = ready.train.select(F.col(cat.KEY).alias("id"), "Target", "scaled", scores.alias("x"))
        found["resampled_counts"] = resample.method_counts(points, params)
    return found


def measures(scored: DataFrame) -> dict[str, DataFrame]:
    """Confusion matrix, precision-recall curve and no-skill rate of each fitted model."""
    return {
        "confusion_matrix": evaluate.confusion_matrix(scored, ["model"]),
        "pr_curve": evaluate.pr_curve(scored, ["model"]),
        "no_skill": scored.groupBy("model").agg(F.avg("label").alias("no_skill")),
    }


def run(
    raw: DataFrame, out: str, params: Params = Params(), families: Sequence[str] = tuple(models.GRIDS),
    resampled: bool = True,
) -> DataFrame:
    """Write all tables under ``out`` and return the model summary.

    The resamplers' counts need neighbour searches whose work grows with the square of the
    minority; ``resampled`` leaves them out.
    """
    spark = tune(raw.sparkSession)

    def write(tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{out}/{name}")

    write(statistics(raw, params))
    ready = prepare.prepare(raw, params)
    write(preparation(ready, params, resampled))
    fits = models.select_models(ready, params, families)
    scored = models.predictions(fits, ready.test)
    scored.write.mode("overwrite").parquet(f"{out}/predictions")
    scored = spark.read.schema(scored.schema).parquet(f"{out}/predictions")
    write(measures(scored))
    summary = models.model_summary(fits, scored)
    writers.write_csv(summary, f"{out}/model_summary")
    writers.write_csv(models.cv_scores(spark, fits), f"{out}/cv_scores")
    for fitted in fits:
        if fitted.name == "RandomForest":
            writers.write_csv(models.forest_importances(fitted, spark), f"{out}/rf_feature_importances")
    return summary


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw", help="Parquet folder of applications with an application_id")
    parser.add_argument("out", help="folder for the result tables")
    parser.add_argument("--train-fraction", type=float, default=0.8)
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("riskloom study").getOrCreate()
    params = Params(test_fraction=round(1 - args.train_fraction, 12), seed=args.seed)
    raw = readers.read_parquet(spark, args.raw, cat.KEYED_SCHEMA)
    run(raw, args.out, params).show(truncate=False)
    drop_scratch(spark)


if __name__ == "__main__":
    main()

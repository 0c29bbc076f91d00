"""Readers for the applications table and the rename map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom import catalog as cat


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Parquet files; a given schema saves the job that would infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = cat.KEYED_SCHEMA) -> DataFrame:
    """A CSV with a header. Empty cells and the literal None are missing.

    The schema is given and not inferred, which saves a pass over the input, and a cell
    that does not fit it stops the job.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "None")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def rename_map_from_json(spark: SparkSession, path: str) -> dict[str, str]:
    """One JSON object of old name to new name."""
    return rename_map_from_frame(spark.read.option("multiLine", True).json(path))


def rename_map_from_frame(df: DataFrame) -> dict[str, str]:
    """The first row of a wide table whose columns are the old names."""
    row = df.first()
    if row is None:
        raise ValueError("the rename table is empty")
    return {old: new for old, new in row.asDict().items() if new is not None}

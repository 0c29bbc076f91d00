"""Writers. Each is one distributed write; a failure fails the job."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    """Header, UTF-8, quoted where needed, NULL as None."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "None")
        .option("emptyValue", "")
        .csv(path)
    )


def write_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> None:
    """Overwrite a catalog table. ``fmt='delta'`` works where that jar is present."""
    writer = df.write.mode("overwrite").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)

"""The feature job over a folder that keeps growing.

The view has no state, so the batch projection also serves a stream. Each run takes the
files that have arrived since the last one; the checkpoint, in the shared folder, records
which, and a restarted run neither repeats nor skips a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom import catalog as cat
from riskloom.operators.features import feature_view


def run_available(
    spark: SparkSession, source: str, sink: str, checkpoint: str, keep: Sequence[str] = (cat.KEY,)
) -> StreamingQuery:
    """Start a run over all new files; it ends by itself."""
    raw = spark.readStream.schema(cat.KEYED_SCHEMA).parquet(source)
    return (
        feature_view(raw, keep)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )

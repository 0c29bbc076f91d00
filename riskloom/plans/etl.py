"""The extract-transform-load job: raw applications to the feature view, written as CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from riskloom.operators.features import feature_view
from riskloom.sources.writers import write_csv


def run(raw: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Write the 98 columns to ``path`` and return the view. A failed write raises.

    One scan, one projection, one distributed write; nothing shuffles.
    """
    view = feature_view(raw, keep)
    write_csv(view, path)
    return view

"""Connected components of an edge table by alternating stars, all on Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import settle


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each node's component, for edges between nodes 0 to n - 1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def stars(edges: DataFrame) -> DataFrame:
    """(u, v): every node u of an edge that isn't its component's least node, and that node v.

    ``edges`` has two long columns u and v. Each round lets every node hand its larger
    neighbours, then its smaller ones, to the least it knows; the rounds grow with the
    logarithm of the longest path. A hub's edges are only ever joined to one minimum, so a
    skewed join can split them; minima are combined before the shuffle.
    """
    now = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    was, this = None, _print(now)
    while this[0] and this != was:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        now = settle(small, "edges")
        was, this = this, _print(now)
    return now

"""Pairwise means and co-moments of many columns in one pass.

Hundreds of built-in ``corr`` aggregates in one query exceed what generated code can
hold: 435 pairs took 190 s on two million rows. Here each task folds its Arrow batches
into small matrices with numpy, and only those matrices shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.codes import q

_PARTS = "i int, j int, n double, mi double, mj double, sii double, sjj double, sij double"


class _CoMoments:
    """Counts, means and centred sums of products over rows where both columns exist.

    Entry [i, j] is about column i of the chosen ones and column j of all.
    """

    def __init__(self, size: int, fixed: int | None = None) -> None:
        self.chosen = slice(None) if fixed is None else slice(fixed, fixed + 1)
        shape = (size if fixed is None else 1, size)
        self.n = np.zeros(shape)
        self.mi, self.mj = np.zeros(shape), np.zeros(shape)
        self.sii, self.sjj, self.sij = np.zeros(shape), np.zeros(shape), np.zeros(shape)

    def add(self, x: np.ndarray) -> None:
        present = ~np.isnan(x)
        mask = present.astype(float)
        filled = np.where(present, x, 0.0)
        centre = filled.sum(0) / np.maximum(mask.sum(0), 1.0)
        v = np.where(present, x - centre, 0.0)
        own, here = v[:, self.chosen], mask[:, self.chosen]
        n = here.T @ mask
        with np.errstate(invalid="ignore", divide="ignore"):
            di = np.where(n > 0, (own.T @ mask) / n, 0.0)
            dj = np.where(n > 0, (here.T @ v) / n, 0.0)
        sii = (own * own).T @ mask - n * di * di
        sjj = here.T @ (v * v) - n * dj * dj
        sij = own.T @ v - n * di * dj
        total = self.n + n
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.where(total > 0, n / total, 0.0)
        gap_i = centre[self.chosen, None] + di - self.mi
        gap_j = centre[None, :] + dj - self.mj
        weight = self.n * share
        self.sii += sii + gap_i * gap_i * weight
        self.sjj += sjj + gap_j * gap_j * weight
        self.sij += sij + gap_i * gap_j * weight
        self.mi += gap_i * share
        self.mj += gap_j * share
        self.n = total


def co_moments(df: DataFrame, columns: Sequence[str], against: str | None = None) -> DataFrame:
    """Rows (i, j, n, mi, mj, sii, sjj, sij) of column positions i < j, over whole pairs.

    With ``against``, only the pairs of that column, i, with each other one, j; no other
    products are computed.
    """
    names = list(columns)
    fixed = None if against is None else names.index(against)
    size = len(names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _CoMoments(size, fixed)
        for batch in batches:
            if batch.num_rows:
                sums.add(
                    np.column_stack(
                        [c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in batch.columns]
                    )
                )
        if fixed is None:
            i, j = np.triu_indices(size, 1)
            row = i
        else:
            j = np.delete(np.arange(size), fixed)
            i, row = np.full(size - 1, fixed), np.zeros(size - 1, dtype=int)
        keep = sums.n[row, j] > 0
        i, j, row = i[keep], j[keep], row[keep]
        found = (sums.n, sums.mi, sums.mj, sums.sii, sums.sjj, sums.sij)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(m[row, j]) for m in found]],
            names=["i", "j", "n", "mi", "mj", "sii", "sjj", "sij"],
        )

    parts = df.select(
        *[q(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)]
    ).mapInArrow(fold, _PARTS)
    # within tasks the sums are centred; between tasks only the task means are combined
    n, mi, mj = F.col("n"), F.col("mi"), F.col("mj")
    merged = parts.groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        (F.sum(n * mi) / F.sum("n")).alias("mi"),
        (F.sum(n * mj) / F.sum("n")).alias("mj"),
        F.sum("sii").alias("sii"),
        F.sum("sjj").alias("sjj"),
        F.sum("sij").alias("sij"),
        F.sum(n * mi * mi).alias("qii"),
        F.sum(n * mj * mj).alias("qjj"),
        F.sum(n * mi * mj).alias("qij"),
    )
    return merged.select(
        "i", "j", "n", "mi", "mj",
        (F.col("sii") + F.col("qii") - n * mi * mi).alias("sii"),
        (F.col("sjj") + F.col("qjj") - n * mj * mj).alias("sjj"),
        (F.col("sij") + F.col("qij") - n * mi * mj).alias("sij"),
    )


def correlations(df: DataFrame, columns: Sequence[str], against: str | None = None) -> DataFrame:
    """Pearson's r of column pairs as (i, j, r); missing where a column does not vary."""
    m = co_moments(df, columns, against)
    # a constant column's centred sum is rounding noise, not variance
    varies = (F.col("sii") > 1e-12 * F.col("n") * (F.col("mi") * F.col("mi") + 1e-300)) & (
        F.col("sjj") > 1e-12 * F.col("n") * (F.col("mj") * F.col("mj") + 1e-300)
    )
    r = F.col("sij") / F.sqrt(F.col("sii") * F.col("sjj"))
    return m.select("i", "j", F.when(varies, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))).alias("r"))

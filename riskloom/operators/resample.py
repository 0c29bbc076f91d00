"""Class rebalancing: SMOTE, cluster-based SMOTE and centroid undersampling.

Inputs are keyed rows with an array<double> of coordinates. Work that compares rows runs
in blocks of limited size, cut by a hash of the key, so a group of any size, or of many
equal rows, spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.hashing import hash_key, hash_uniform
from riskloom.operators.neighbours import nearest
from riskloom.operators.ordering import fit_hash_cuts, running_sums
from riskloom.session import settle

# rows per block: the distances between two blocks take 32 MB
BLOCK_ROWS = 2_048
# majority rows per undersampling cell
CELL_ROWS = 2_000

# rows of the pieces of a block that are compared together
TILE_ROWS = 128
# blocks of one run: two runs meet in a task
RUN_BLOCKS = 48

_SPREAD = "grp int, total double"
_BLOCK = "grp int, block int, n bigint, x binary"


# --- distances between all rows -------------------------------------------------------


def _sorted_rows(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pdf["id"].to_numpy(), kind="stable")
    return pdf["id"].to_numpy()[order], np.stack(pdf["x"].to_numpy()[order])


def _packed_blocks(points: DataFrame) -> DataFrame:
    """Rows (grp, id, x) as one row (grp, block, x) per block, its coordinates packed in id order.

    A row moves once. Each group gets as many blocks as its rows need. The number of groups is
    small: the clusters, or one.
    """
    sizes = points.groupBy("grp").agg(
        F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks")
    )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        _, x = _sorted_rows(rows)
        return pd.DataFrame({
            "grp": [rows["grp"].iloc[0]], "block": [rows["block"].iloc[0]], "n": [len(x)], "x": [x.tobytes()],
        })

    blocked = points.join(F.broadcast(sizes), "grp").select(
        "grp", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "x"
    )
    return blocked.groupBy("grp", "block").applyInPandas(pack, _BLOCK)


def _pair_total(x: np.ndarray, y: np.ndarray, same: bool) -> float:
    """The distances from every row of one block to every row of another, both ways.

    The squared norms are two more coordinates, so that one product gives the squared distances,
    and a piece of them stays in the cache until its roots are summed.
    """
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    x = np.column_stack([-2.0 * x, xx, np.ones(len(x))])
    y = np.column_stack([y, np.ones(len(y)), yy])
    total = 0.0
    for a in range(0, len(x), TILE_ROWS):
        for b in range(0, len(y), 2 * TILE_ROWS):
            fast = x[a : a + TILE_ROWS] @ y[b : b + 2 * TILE_ROWS].T
            if same and b <= a < b + 2 * TILE_ROWS:
                np.fill_diagonal(fast[:, a - b :], 0.0)
            np.maximum(fast, 0.0, out=fast)
            total += float(np.sqrt(fast, out=fast).sum())
    return total * (1.0 if same else 2.0)


def mean_distance(points: DataFrame) -> DataFrame:
    """(grp, rows, mean_distance) over all pairs of distinct rows of each group.

    Every two blocks of a group meet once. Blocks are written once, and a task takes the pairs
    of two runs of blocks from there: what is written grows with the rows, only the comparisons
    with their square.
    """
    packed = settle(_packed_blocks(points), "grp")
    runs = max(1, -(-packed.count() // RUN_BLOCKS))
    dealt = packed.repartition(runs, "grp", "block")
    a, b = dealt.alias("a"), dealt.hint("shuffle_replicate_nl").alias("b")
    pairs = a.join(b, (F.col("a.grp") == F.col("b.grp")) & (F.col("a.block") <= F.col("b.block"))).select(
        F.col("a.grp").alias("grp"), (F.col("a.block") == F.col("b.block")).alias("same"),
        F.col("a.n").alias("n"), F.col("b.n").alias("m"), F.col("a.x").alias("x"), F.col("b.x").alias("y"),
    )

    def compare(batches):
        for batch in batches:
            totals = []
            columns = (batch.column(c) for c in ("same", "n", "m", "x", "y"))
            for same, n, m, x, y in zip(*columns):
                x, y = (np.frombuffer(v.as_buffer()).reshape(w.as_py(), -1) for v, w in ((x, n), (y, m)))
                totals.append(_pair_total(x, y, same.as_py()))
            yield pa.RecordBatch.from_arrays([batch.column("grp"), pa.array(totals, pa.float64())], ["grp", "total"])

    totals = pairs.mapInArrow(compare, _SPREAD).groupBy("grp").agg(F.sum("total").alias("total"))
    rows = packed.groupBy("grp").agg(F.sum("n").alias("rows"))
    pairs_ = F.col("rows") * (F.col("rows") - 1)
    return rows.join(totals, "grp").select(
        "grp", "rows", F.when(pairs_ > 0, F.col("total") / pairs_).otherwise(0.0).alias("mean_distance")
    )


# --- SMOTE ----------------------------------------------------------------------------


def synthesize(points: DataFrame, quota: dict[int, int], k: int, seed: int) -> DataFrame:
    """New rows (grp, id, copy, x) on segments between a row and one of its k nearest.

    ``quota`` says how many each group gets. As in Chawla et al., 2002, every row of a
    group serves as base equally often; which rows serve once more is drawn by hash, as
    are neighbour and position on the segment. A group with a quota needs k + 1 rows.
    """
    sizes = {r["grp"]: r["count"] for r in points.groupBy("grp").count().collect()}
    quota = {g: n for g, n in quota.items() if n > 0}
    short = {g: sizes.get(g, 0) for g in quota if sizes.get(g, 0) <= k}
    if short:
        raise ValueError(f"{k} neighbours need {k + 1} rows in a group; rows by group: {short}")
    if not quota:
        return points.where("false").select("grp", "id", F.lit(0).alias("copy"), "x")
    spark = points.sparkSession
    plan = F.broadcast(
        spark.createDataFrame(
            [(g, n // sizes[g], n % sizes[g], k) for g, n in quota.items()],
            "grp int, each bigint, extra bigint, reach int",
        )
    )
    chosen = points.where(F.col("grp").isin(list(quota)))
    digest = hash_key(seed, "base", F.col("id"))
    cuts = fit_hash_cuts(chosen, "grp", digest, [lambda size, g: quota[g] % size])
    copies = F.col("each") + (cuts.above(digest) == 0).cast("bigint")
    bases = (
        chosen.join(plan, "grp")
        .withColumn("copies", copies)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    )
    pick = F.floor(hash_uniform(seed, "neighbour", F.col("id"), F.col("copy")) * F.col("reach")) + 1
    drawn = bases.select("grp", "id", "copy", "x", pick.cast("int").alias("place"))
    near = nearest(chosen, k)
    other = chosen.select(F.col("grp"), F.col("id").alias("neighbour"), F.col("x").alias("y"))
    joined = drawn.join(near, ["grp", "id", "place"]).join(other, ["grp", "neighbour"])
    gap = hash_uniform(seed, "gap", F.col("id"), F.col("copy"))
    return joined.withColumn("gap", gap).select(
        "grp", "id", "copy",
        F.zip_with("x", "y", lambda a, b: a + F.col("gap") * (b - a)).alias("x"),
    )


def smote(points: DataFrame, label: str = "Target", k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows (label, id, copy, x) that raise the minority to the majority's count."""
    counts = class_counts(points, label)
    minority, missing = _shortfall(counts)
    rows = points.where(F.col(label) == minority).select(F.lit(0).alias("grp"), "id", "x")
    made = synthesize(rows, {0: missing}, k, seed)
    return made.select(F.lit(minority).alias(label), "id", F.col("copy").cast("int").alias("copy"), "x")


def class_counts(points: DataFrame, label: str) -> dict[int, int]:
    return {r[label]: r["count"] for r in points.groupBy(label).count().collect()}


def _shortfall(counts: dict[int, int]) -> tuple[int, int]:
    if len(counts) != 2:
        raise ValueError(f"rebalancing needs two classes, found {sorted(counts)}")
    minority = min(counts, key=lambda c: (counts[c], c))
    return minority, max(counts.values()) - counts[minority]


# --- cluster-based SMOTE --------------------------------------------------------------


def largest_remainders(total: int, weights: Sequence[float]) -> list[int]:
    """Whole shares of ``total`` in proportion to ``weights``, adding up exactly."""
    whole = float(sum(weights))
    exact = [total * w / whole for w in weights]
    shares = [int(e) for e in exact]
    order = sorted(range(len(exact)), key=lambda i: (shares[i] - exact[i], i))
    for i in order[: total - sum(shares)]:
        shares[i] += 1
    return shares


def cluster_smote(
    points: DataFrame, vectors: str, label: str = "Target", clusters: int = 8, k: int = 2,
    threshold: float | None = None, seed: int = 42, iterations: int = 300,
) -> DataFrame:
    """SMOTE inside the clusters that hold enough of the minority, sparser ones more.

    After Douzas et al., 2018. ``threshold`` is the minority share a cluster needs; None
    takes half the share of all rows that are missing. The clusters' weights, a handful of
    numbers, are collected.
    """
    counts = class_counts(points, label)
    minority, missing = _shortfall(counts)
    needed = missing / sum(counts.values()) / 2 if threshold is None else threshold
    model = KMeans(k=clusters, seed=seed, featuresCol=vectors, predictionCol="grp", maxIter=iterations).fit(points)
    placed = model.transform(points).select("grp", "id", "x", label)
    shares = {
        r["grp"]: r for r in placed.groupBy("grp").agg(
            F.count("*").alias("rows"), F.count_if(F.col(label) == minority).alias("few")
        ).collect()
    }
    valid = sorted(
        g for g, r in shares.items() if r["few"] / r["rows"] >= needed and r["few"] >= k + 1
    )
    if not valid:
        raise ValueError("no cluster holds enough minority rows; lower the threshold")
    rows = placed.where((F.col(label) == minority) & F.col("grp").isin(valid)).select("grp", "id", "x")
    spread = {r["grp"]: r for r in mean_distance(rows).collect()}

    # sparsity = mean distance ^ (log_1.6(rows)^1.8 * 0.16) / rows, as logarithms: the
    # powers of large clusters overflow
    logs = []
    for g in valid:
        n, d = spread[g]["rows"], spread[g]["mean_distance"]
        power = (np.log(n) / np.log(1.6)) ** 1.8 * 0.16
        logs.append(power * np.log(d) - np.log(n) if d > 0 else -np.inf)
    top = max(logs)
    weights = [float(np.exp(v - top)) if np.isfinite(top) else 1.0 for v in logs]
    quota = dict(zip(valid, largest_remainders(missing, weights)))
    made = synthesize(rows, quota, k, seed)
    return made.select(
        F.lit(minority).alias(label), "id", F.col("copy").cast("int").alias("copy"), "x",
        F.col("grp").alias("cluster"),
    )


def method_counts(points: DataFrame, params, label: str = "Target") -> DataFrame:
    """(method, label, n): rows of each class before and after each resampler.

    ``points`` has id, the label, x (the components as an array) and the vector scaled.
    """
    labels = points.select(label)
    counts = class_counts(points, label)
    minority = min(counts, key=lambda c: (counts[c], c))
    kept = labels.where(F.col(label) == minority)
    whole = points.withColumn("x", vector_to_array("scaled"))
    made = {
        "Original": labels,
        "ClusterCentroids": kept.unionByName(undersample_centroids(points, label, params.seed).select(label)),
        "SMOTE": labels.unionByName(smote(points, label, params.smote_neighbours, params.seed).select(label)),
        "KMeans-SMOTE": labels.unionByName(
            cluster_smote(
                whole, "scaled", label, params.cluster_smote_clusters, params.cluster_smote_neighbours,
                params.cluster_smote_threshold, params.seed,
            ).select(label)
        ),
    }
    parts = [
        df.groupBy(label).agg(F.count("*").alias("n")).select(F.lit(name).alias("method"), label, "n")
        for name, df in made.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- centroid undersampling -----------------------------------------------------------


def _cell(axes: int, middles: Sequence[float]) -> Column:
    """A number from the sides of the medians a row lies on, one bit per coordinate."""
    bits = [
        F.when(F.col("x")[d] > middles[d], F.lit(1 << d)).otherwise(F.lit(0)).cast("bigint")
        for d in range(axes)
    ]
    return sum(bits[1:], bits[0]) if bits else F.lit(0).cast("bigint")


def undersample_centroids(points: DataFrame, label: str = "Target", seed: int = 42, cell_rows: int | None = None) -> DataFrame:
    """Replace the majority by as many k-means centroids as the minority has rows.

    One k-means with that many centres does not scale, so space is cut at the medians of
    the leading coordinates into cells of about ``cell_rows`` rows; a cell with more, such
    as one of equal rows, is cut further by hash. Each cell gets its share of centroids by
    rounded running sums, which add up exactly, and clusters on its own until its centres
    stay. Rows that fit one cell are one clustering.
    """
    cell_rows = cell_rows or CELL_ROWS
    counts = class_counts(points, label)
    minority, _ = _shortfall(counts)
    majority = next(c for c in counts if c != minority)
    wanted, rows = counts[minority], counts[majority]
    many = points.where(F.col(label) == majority).select("id", "x")
    width = many.select(F.size("x")).first()[0]
    axes = min(max(0, int(np.ceil(np.log2(max(rows, 1) / cell_rows)))), width)
    middles = list(
        many.agg(F.lit(0), *[F.percentile_approx(F.col("x")[d], 0.5) for d in range(axes)]).first()
    )[1:]
    celled = many.withColumn("cell", _cell(axes, middles))
    sizes = celled.groupBy("cell").agg(F.count("*").alias("size"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(2 * cell_rows)))
    placed = celled.join(sizes, "cell").withColumn(
        "piece", F.pmod(F.xxhash64("id"), pieces).cast("bigint")
    ).select("cell", "piece", "id", "x")
    # the share of each piece; the table of pieces is a two-thousandth of the rows
    shares = placed.groupBy("cell", "piece").agg(F.count("*").alias("n")).withColumn(
        "at", F.xxhash64("cell", "piece")
    ).withColumn("bucket", F.shiftright("at", 48))
    summed = running_sums(shares, [], "bucket", "at", {"upto": "n"})
    ratio = F.lit(float(wanted)) / F.lit(float(rows))
    upto = F.when(F.col("upto") == rows, F.lit(wanted)).otherwise(F.floor(F.col("upto") * ratio))
    from_ = F.floor((F.col("upto") - F.col("n")) * ratio)
    take = summed.select("cell", "piece", (upto - from_).cast("int").alias("take")).where("take > 0")

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = _sorted_rows(pdf)
        centres = _lloyd(x, int(pdf["take"].iloc[0]))
        return pd.DataFrame(
            {
                "cell": pdf["cell"].iloc[0], "piece": pdf["piece"].iloc[0],
                "centre": np.arange(len(centres)), "x": list(centres),
            }
        )

    found = placed.join(take, ["cell", "piece"]).groupBy("cell", "piece").applyInPandas(
        cluster, "cell bigint, piece bigint, centre int, x array<double>"
    )
    return found.select(F.lit(majority).alias(label), "cell", "piece", "centre", "x")


def _lloyd(x: np.ndarray, k: int) -> np.ndarray:
    """k centres of the rows of one cell, moved until no row changes its centre.

    Each round lowers the sum of squares, so the loop ends. A centre that attracts no row
    keeps its place; of equally near centres the first takes the row.
    """
    start = np.argsort(x[:, 0], kind="stable")[np.linspace(0, len(x) - 1, k).astype(int)]
    centres = x[start].copy()
    own, best = None, np.inf
    while True:
        distance = (centres**2).sum(1)[None, :] - 2.0 * x @ centres.T
        now = np.argmin(distance, axis=1)
        total = float(distance[np.arange(len(x)), now].sum())
        if own is not None and ((now == own).all() or total >= best):
            return centres
        own, best = now, total
        size = np.bincount(now, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, now, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)

"""Exact top-k by inner product on a bit-sliced index.

The index keeps, for each block of rows, dimension and bit, one bitmap over the block's
rows. A query adds the slices that its own digits select with carry-save bitmap arithmetic,
which leaves the scores of all rows of the block as slices; the best rows are then taken
from the most significant slice downward, and ties on the boundary go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import pieces, ready, settle

BLOCK_ROWS = 32_768
QUERY_BLOCK = 256
GROUP_BYTES = 64 << 20  # digits of the queries that a task holds
ALL = np.uint64(2**64 - 1)

_INDEX = "dims int, n int, bits int, low long, ids binary, slices binary"
_QUERIES = "dims int, ids binary, keys binary, digits binary"
_HITS = "query_id long, query_key long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, key, v): components as floor(scale * x); vectors that can't take part left out.

    Left out: null vec_id or vector, a null, NaN or infinite component. ``key`` tells
    different vectors of one vec_id apart.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("v"),
    ).withColumn("key", F.xxhash64("v"))


def _by_length(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(dims, ids, keys, values) for blocks of up to ``rows`` vectors of one length."""
    held: dict[int, list] = {}
    for batch in batches:
        v = batch.column("v")
        sizes = np.asarray(pa.compute.list_value_length(v), dtype=np.int64)
        ids, keys = (np.asarray(batch.column(c), dtype=np.int64) for c in ("vec_id", "key"))
        flat, ends = np.asarray(v.flatten(), dtype=np.int64), np.cumsum(sizes)
        for dims in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dims)
            values = flat[(ends[at] - dims)[:, None] + np.arange(dims)]
            held.setdefault(dims, []).append((ids[at], keys[at], values))
            while sum(len(p[0]) for p in held[dims]) >= rows:
                whole = [np.concatenate(c) for c in zip(*held[dims])]
                yield dims, *(c[:rows] for c in whole)
                held[dims] = [tuple(c[rows:] for c in whole)]
    for dims, parts in held.items():
        whole = [np.concatenate(c) for c in zip(*parts)]
        if len(whole[0]):
            yield dims, *whole


def _index_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for dims, ids, _, values in _by_length(batches, rows):
        order = np.argsort(ids, kind="stable")  # bit order is id order
        ids, values = ids[order], values[order]
        low = int(values.min(initial=0))
        bits = max(1, (int(values.max(initial=0)) - low).bit_length())
        above = (values - low).astype(np.uint64).T
        wide = -(-len(ids) // 64) * 64
        slices = np.zeros((dims, bits, wide // 64), dtype=np.uint64)
        plane = np.zeros((dims, wide), dtype=np.uint8)
        for j in range(bits):
            plane[:, : len(ids)] = (above >> np.uint64(j)) & np.uint64(1)
            slices[:, j] = np.packbits(plane, axis=1, bitorder="little").view("<u8")
        yield pa.RecordBatch.from_pydict({
            "dims": pa.array([dims], pa.int32()), "n": pa.array([len(ids)], pa.int32()), "bits": pa.array([bits], pa.int32()),
            "low": pa.array([low]), "ids": pa.array([ids.tobytes()]), "slices": pa.array([slices.tobytes()]),
        })


def _query_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for dims, ids, keys, values in _by_length(batches, rows):
        yield pa.RecordBatch.from_pydict({
            "dims": pa.array([dims], pa.int32()), "ids": pa.array([ids.tobytes()]),
            "keys": pa.array([keys.tobytes()]), "digits": pa.array([np.ascontiguousarray(values).tobytes()]),
        })


def score_slices(slices: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of sum(query[d] * value[d]) less a constant, least significant first, and it.

    Query components are written with digits -1, 0, 1, few of them non-zero. A slice under
    a negative digit is complemented: -b is (not b) - 1, and the ones gather in the constant.
    """
    dims, bits, width = slices.shape
    size = np.abs(query)
    half = size >> 1
    more = size + half
    plus, minus = more & (half ^ more), half & (half ^ more)
    steps = np.arange(max(1, int(more.max(initial=0)).bit_length()))
    d, i = np.nonzero(((plus | minus)[:, None] >> steps) & 1)
    negative = ((minus[d] >> i) & 1).astype(bool) ^ (query[d] < 0)
    flip = np.where(negative, ALL, np.uint64(0))[:, None]
    constant = -sum(int(np.sum(1 << i[negative])) << j for j in range(bits))
    out, carried = [], []
    weight = 0
    while weight < len(steps) + bits or carried:
        j = weight - i
        there = (j >= 0) & (j < bits)
        rows = slices[d[there], j[there]] ^ flip[there]
        if carried:
            rows = np.concatenate([rows, *carried])
        carried = []
        while len(rows) > 2:
            t = len(rows) // 3
            a, b, c = rows[:t], rows[t : 2 * t], rows[2 * t : 3 * t]
            ab = a ^ b
            carried.append((a & b) | (c & ab))
            ab ^= c
            rows = ab if 3 * t == len(rows) else np.concatenate([ab, rows[3 * t :]])
        if len(rows) == 2:
            carried.append((rows[0] & rows[1])[None])
            rows = rows[:1] ^ rows[1:]
        out.append(rows[0] if len(rows) else np.zeros(width, dtype=np.uint64))
        weight += 1
    return out, constant


def _rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best_rows(score: list[np.ndarray], open_rows: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` best of the open rows, from the top slice down; ties to the lower row."""
    sure, tied = np.zeros_like(open_rows), open_rows
    have = 0
    for s in reversed(score):
        with_bit = tied & s
        n = int(np.bitwise_count(with_bit).sum())
        if have + n > k:
            tied = with_bit
        else:
            sure, have, tied = sure | with_bit, have + n, tied & ~s
            if have == k:
                return _rows_of(sure)
    return np.r_[_rows_of(sure), _rows_of(tied)[: k - have]]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            dims, n, bits, low = row["dims"], row["n"], row["bits"], row["low"]
            ids = np.frombuffer(row["ids"], dtype=np.int64)
            slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(dims, bits, -(-n // 64))
            queries = np.frombuffer(row["query_ids"], dtype=np.int64)
            keys = np.frombuffer(row["query_keys"], dtype=np.int64)
            digits = np.frombuffer(row["digits"], dtype=np.int64).reshape(len(queries), dims)
            most = (1 << bits) * max(1, dims) * (2 * int(np.abs(digits).max(initial=0)) + 1) + abs(low) * int(np.abs(digits).sum(axis=1).max(initial=0))
            if most >= 2**62:
                raise ValueError("components too large: scores would not fit a long")
            full = np.zeros(slices.shape[2] if dims else -(-n // 64), dtype=np.uint64)
            full.view(np.uint8)[: n // 8] = 255
            if n % 8:
                full.view(np.uint8)[n // 8] = (1 << n % 8) - 1
            if not dims:
                slices = np.zeros((0, 1, len(full)), dtype=np.uint64)
            found = []
            for q, query in enumerate(digits):
                score, constant = score_slices(slices, query)
                constant += low * int(query.sum())
                own = np.arange(*np.searchsorted(ids, [queries[q], queries[q] + 1]))
                open_rows = full.copy()
                for r in own:
                    open_rows[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
                rows = best_rows(score, open_rows, k)
                stack = np.stack([s[rows >> 6] for s in score]) >> (rows & 63).astype(np.uint64) & np.uint64(1)
                value = (stack.astype(np.int64) << np.arange(len(score))[:, None]).sum(axis=0) + constant
                found.append((np.full(len(rows), q), ids[rows], value))
            q, vec, value = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array(queries[q]), "query_key": pa.array(keys[q]), "vec_id": pa.array(vec), "score": pa.array(value),
            })


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The bit-sliced index of all vectors, written to the shared folder, a row per block.

    ``block`` numbers the blocks; those of vectors of several lengths may share a number.
    """
    rows = quantised(vectors).select("vec_id", "key", "v")
    blocks = max(1, -(-rows.count() // block_rows))
    made = rows.repartition(blocks).mapInArrow(lambda it: _index_blocks(it, block_rows), _INDEX)
    return settle(made.withColumn("block", F.spark_partition_id()), "bitsliced")


def search(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best rows of ``index`` for each query: query_id, rank, vec_id, score.

    ``queries`` has the columns of ``quantised``. Query blocks meet index blocks in a grid of
    (slot, group) cells by an equi-join: index blocks are copied once for each group, query
    blocks once for each slot. The groups follow the bytes of the queries, so that a task holds
    about ``GROUP_BYTES`` of them, and one index block at a time; the slots make up a few cells
    for each piece of a shuffle.
    """
    asked = queries.dropDuplicates(["vec_id", "key"])
    size = asked.agg(F.count("*").alias("n"), F.sum(8 * F.size("v")).alias("bytes")).first()
    count = max(1, -(-size["n"] // QUERY_BLOCK))
    groups = max(min(8, count), -(-(size["bytes"] or 0) // GROUP_BYTES))
    blocks = (index.agg(F.max("block")).first()[0] or 0) + 1
    slots = min(blocks, -(-4 * pieces(index.sparkSession) // groups))
    asked = (
        asked.repartition(count).mapInArrow(lambda it: _query_blocks(it, QUERY_BLOCK), _QUERIES)
        .withColumn("grp", F.pmod(F.spark_partition_id(), F.lit(groups)))
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        .select("grp", "slot", "dims", F.col("ids").alias("query_ids"), F.col("keys").alias("query_keys"), "digits")
    )
    blocks = index.withColumn("slot", F.pmod("block", F.lit(slots))).withColumn(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    hits = (
        blocks.join(asked.hint("shuffle_hash"), ["slot", "grp", "dims"])
        .select("dims", "n", "bits", "low", "ids", "slices", "query_ids", "query_keys", "digits")
        .mapInArrow(lambda it: _search(it, k), _HITS)
    )
    place = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The ``k`` highest integer inner products of every ``every``-th row with all others.

    ``vectors`` has vec_id and embedding; other columns are ignored. Queries are the rows
    whose vec_id is divisible by ``every``; ties go to the smaller vec_id.

    - Vectors that ``quantised`` leaves out take no part, neither as query nor as candidate.
    - Vectors of different lengths have no score with each other; two empty ones score 0.
    - Rows that share the query's vec_id are its own and no candidates. A query repeated in
      full is one query; repeated candidates come as often as their rows.
    - Fewer than ``k`` candidates: all are returned. An empty table gives an empty result.
    - A ValueError is raised where scores might not fit a long.
    """
    spark = ready(vectors.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    queries = quantised(vectors.where(F.col("vec_id") % every == 0)).select("vec_id", "key", "v")
    return search(build_index(vectors), queries, k)

"""Approximate nearest neighbours by multi-index hashing.

Vectors get 64-bit codes: signs after principal axes and a rotation that is learned so that
signs lose little (iterative quantisation). A code is split into four substrings and each
substring is an index of its own. Two codes that differ in at most r bits differ little in
some substring, so probing every substring within its share of r finds every code within r;
the codes found are ranked again by exact distance on the original vectors.

The radius follows from the data. A bounded sample says how many bits lie between vectors of
a given distance; a query first looks within a radius that should hold some hundred rows, and
looks again, within the radius that its tenth distance asks for, if that is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import pieces, ready, runs, settle

BITS, PARTS = 64, 4
WIDTH = BITS // PARTS
SAMPLE = 4_096  # rows that the rotation and the calibration are fitted on
ASKING = 256  # of these, rows that stand for queries in the calibration
CELL_ROWS = 2_048  # rows that a task holds at once
QUERY_ROWS = 256
EXPECTED = 100  # rows that the first radius should find
RECALL = 0.97  # share of neighbours that the second radius should reach

_IDS = "array<struct<vec_id: long, n: long>>"


# --- codes --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rotation:
    """Codes for vectors of one length."""

    mean: np.ndarray
    axes: np.ndarray  # length x BITS

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def fit_rotation(x: np.ndarray, seed: int = 0, rounds: int = 30) -> Rotation:
    """Iterative quantisation of the leading axes; short vectors are rotated several times."""
    mean, dims = x.mean(axis=0), x.shape[1]
    centred = x - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    kept = min(dims, BITS)
    axes = vectors[:, ::-1][:, :kept]
    low = centred @ axes
    draw, found = np.random.default_rng(seed), []
    for _ in range(-(-BITS // kept)):
        turn = np.linalg.qr(draw.normal(size=(kept, kept)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ vt).T
        found.append(axes @ turn)
    return Rotation(mean, np.concatenate(found, axis=1)[:, :BITS])


class Codes:
    """A rotation for each length that the sample has; others are turned at random."""

    def __init__(self, sample: list[np.ndarray]):
        by_length: dict[int, list[np.ndarray]] = {}
        for v in sample:
            by_length.setdefault(len(v), []).append(v)
        self.fitted = {n: fit_rotation(np.stack(v)) for n, v in by_length.items()}

    def of(self, dims: int) -> Rotation:
        if dims not in self.fitted:
            self.fitted[dims] = Rotation(np.zeros(dims), np.random.default_rng(dims).normal(size=(dims, BITS)))
        return self.fitted[dims]


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :])


@dataclass(frozen=True)
class Calibration:
    """Bits that hold ``RECALL`` of the pairs up to a distance; distances relative to the data."""

    distances: np.ndarray
    bits: np.ndarray
    first: int

    def radius(self, distance: Column) -> Column:
        """The radius that a query with this tenth distance needs; without one, all bits."""
        out = F.lit(int(self.bits[-1]))
        for d, b in zip(self.distances[::-1].tolist(), self.bits[::-1].tolist()):
            out = F.when(distance <= d, int(b)).otherwise(out)
        return F.when(distance.isNull(), BITS).otherwise(out)


def calibrate(sample: list[np.ndarray], codes: Codes, rows: int) -> Calibration:
    """From the pairs of up to ``ASKING`` sampled rows with the others of their length."""
    dist, bits, near = [], [], []
    by_length: dict[int, list[np.ndarray]] = {}
    for v in sample:
        by_length.setdefault(len(v), []).append(v)
    for dims, vectors in by_length.items():
        x = np.stack(vectors)
        code = codes.of(dims).codes(x).view(np.uint64)
        ask = np.arange(min(ASKING, len(x)))
        d = np.sqrt(np.maximum((x[ask] ** 2).sum(1)[:, None] + (x**2).sum(1) - 2.0 * x[ask] @ x.T, 0.0))
        h = hamming(code[ask], code).astype(np.int64)
        other = np.ones_like(h, dtype=bool)
        other[ask, ask] = False
        dist.append(d[other])
        bits.append(h[other])
        near.append(np.bincount(h[other], minlength=BITS + 1) / max(len(ask), 1))
    if not dist or not sum(map(len, dist)):
        return Calibration(np.zeros(0), np.asarray([BITS]), BITS)
    d, h = np.concatenate(dist), np.concatenate(bits)
    order = np.argsort(d, kind="stable")
    d, h = d[order], h[order]
    ends = np.unique(np.minimum(len(d), np.geomspace(min(100, len(d)), len(d), 24)).astype(int))
    needed = np.maximum.accumulate([int(np.quantile(h[:e], RECALL, method="higher")) for e in ends])
    reach = np.cumsum(sum(near)) * rows / len(sample)
    first = int(np.searchsorted(reach, EXPECTED))
    return Calibration(d[ends - 1], np.minimum(needed, BITS), min(first, BITS))


# --- probing ------------------------------------------------------------------------------


def shares(radius: int) -> list[int]:
    """How far each substring is probed so that every code within ``radius`` is met.

    Were each substring to differ by more than its share, the code would differ by the sum of
    the shares and one each, more than ``radius``. Where that touches as many rows as one
    substring probed in full, that is done instead. -1 is a substring not probed.
    """
    whole = [WIDTH] + [-1] * (PARTS - 1)
    each, more = divmod(radius + 1, PARTS)
    split = [each - 1 + (j < more) for j in range(PARTS)]
    ball = np.cumsum([comb(WIDTH, i) for i in range(WIDTH + 1)])
    return split if each <= WIDTH and sum(int(ball[t]) for t in split if t >= 0) < 1 << WIDTH else whole


def substring(code: Column, j: int, prefix: int) -> Column:
    """The leading ``prefix`` bits of substring j: the cell a row lies in."""
    return F.shiftrightunsigned(code, j * WIDTH + WIDTH - prefix).bitwiseAND(F.lit((1 << prefix) - 1)).cast("int")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): vectors that take part, floats as floats and all else as doubles.

    Left out: null vec_id or vector, a null or non-finite component, all components zero.
    """
    kind = "float" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "double"
    x = F.transform("embedding", lambda e: e.cast(kind))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    # -0.0 becomes 0.0, so equal vectors are equal keys
    return rows.where(~bad & F.exists("x", lambda e: e != 0)).select("vec_id", F.transform("x", lambda e: e + F.lit(0.0).cast(kind)).alias("x"))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(x, ids): each different vector once, with the k + 1 least vec_ids that have it.

    More of them cannot be among the k nearest of any query: ties go to smaller ids, and at
    most one of these ids is the query's own.
    """
    counted = rows.groupBy("x", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    place = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    least = counted.withColumn("place", place).where(F.col("place") <= k + 1)
    return least.groupBy("x").agg(F.array_sort(F.collect_list(F.struct("vec_id", "n"))).alias("ids"))


def _encode(batches: Iterator[pa.RecordBatch], codes: Codes, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("x")
        dims = np.asarray(pa.compute.list_value_length(x), dtype=np.int32)
        flat, ends = np.asarray(x.flatten()), np.cumsum(dims)
        code = np.zeros(len(dims), dtype=np.int64)
        for n in np.unique(dims).tolist():
            at = np.flatnonzero(dims == n)
            code[at] = codes.of(n).codes(flat[(ends[at] - n)[:, None] + np.arange(n)])
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(dims), *(batch.column(c) for c in names)], ["code", "dims", *names])


@dataclass(frozen=True)
class Index:
    """Coded rows in the shared folder and what a search needs to know of them."""

    table: DataFrame  # code, dims, x, ids
    codes: Codes
    calibration: Calibration
    prefix: int  # bits of a substring that name a cell
    cells: DataFrame  # dims, part, cell, salts


def build_index(vectors: DataFrame, k: int = 10) -> Index:
    """Fits codes on ``SAMPLE`` rows and indexes every row.

    The sample is the rows of the least hashes. Cells hold about ``CELL_ROWS`` rows while
    substrings have bits for that; a fuller cell, such as one of near copies, is dealt out
    over as many salts as it has such blocks.
    """
    rows = settle(distinct_vectors(usable(vectors), k), "distinct-vectors")
    sample = [np.asarray(r.x, dtype=np.float64) for r in rows.select("x").orderBy(F.xxhash64("x"), "x").limit(SAMPLE).collect()]
    codes = Codes(sample)
    n = rows.count()
    calibration = calibrate(sample, codes, n)
    kind = rows.schema["x"].dataType.simpleString()
    coded = settle(rows.mapInArrow(lambda it: _encode(it, codes, ["x", "ids"]), f"code long, dims int, x {kind}, ids {_IDS}"), "coded-vectors")
    prefix = min(WIDTH, max(0, int(np.ceil(np.log2(max(n, 1) / CELL_ROWS)))))
    parts = F.explode(F.array(*[F.struct(F.lit(j).alias("part"), substring(F.col("code"), j, prefix).alias("cell")) for j in range(PARTS)]))
    cells = coded.select("dims", parts.alias("p")).groupBy("dims", "p.part", "p.cell").agg(F.ceil(F.count("*") / F.lit(CELL_ROWS)).cast("int").alias("salts"))
    return Index(coded, codes, calibration, prefix, settle(cells, "vector-cells"))


def _probe(batches: Iterator[pa.RecordBatch], prefix: int) -> Iterator[pa.RecordBatch]:
    """Each query once for every cell of every substring that its radius touches."""
    masks = np.asarray(sorted(range(1 << prefix), key=lambda m: (m.bit_count(), m)), dtype=np.uint64)
    weight = np.bitwise_count(masks)
    for batch in batches:
        code = np.asarray(batch.column("code")).view(np.uint64)
        for i, radius in enumerate(batch.column("radius").to_pylist()):
            for j, t in enumerate(shares(radius)):
                if t < 0:
                    continue
                at = _cells(code[i : i + 1], j, prefix) ^ masks[: np.searchsorted(weight, t, side="right")]
                rows = batch.take(pa.array(np.full(len(at), i)))
                yield rows.append_column("part", pa.array(np.full(len(at), j, dtype=np.int32))).append_column("cell", pa.array(at.astype(np.int32)))


def _cells(code: np.ndarray, j: int, prefix: int) -> np.ndarray:
    return (code >> np.uint64((j * WIDTH + WIDTH - prefix) % BITS)) & np.uint64((1 << prefix) - 1)


def _nearest(x: np.ndarray, y: np.ndarray, open_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of at least the k nearest open columns of each row.

    A matrix product rules out what is too far, with room for its rounding; the rest are
    measured by their differences.
    """
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    fast = np.where(open_, xx[:, None] + yy - 2.0 * (x @ y.T), np.inf)
    slack = 1e-14 * (x.shape[1] + 8) * (float(xx.max(initial=0)) + float(yy.max(initial=0)))
    if fast.shape[1] > k:
        reach = np.partition(fast, k - 1, axis=1)[:, k - 1] + 2.0 * slack
        open_ = open_ & (fast <= reach[:, None])
    row, col = np.nonzero(open_)
    out = np.empty(len(row))
    for a in range(0, len(row), 1 << 16):  # whatever the number of ties, few differences at once
        part = slice(a, a + (1 << 16))
        out[part] = np.sqrt(((x[row[part]] - y[col[part]]) ** 2).sum(axis=1))
    return row, col, out


class _Cell:
    """The rows of one cell: codes, vectors and who has them."""

    def __init__(self, part: int, blocks: list[tuple]):
        self.part = part
        self.code = np.concatenate([b[0] for b in blocks])
        self.x = np.concatenate([b[1] for b in blocks]).astype(np.float64)
        self.sizes = np.concatenate([b[2] for b in blocks])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.ids, self.n = (np.concatenate([b[i] for b in blocks]) for i in (3, 4))

    def answer(self, name: np.ndarray, key: np.ndarray, code: np.ndarray, x: np.ndarray, radius: np.ndarray, k: int) -> pa.RecordBatch:
        """The k nearest of each query among rows within its radius that this substring finds first."""
        share = np.asarray([shares(r) for r in radius.tolist()]).reshape(-1, PARTS)
        differ = code[:, None] ^ self.code[None, :]
        open_ = np.bitwise_count(differ) <= radius[:, None]
        mask = np.uint64((1 << WIDTH) - 1)
        for j in range(self.part + 1):
            met = np.bitwise_count((differ >> np.uint64(j * WIDTH)) & mask).astype(np.int64) <= share[:, j][:, None]
            open_ &= met if j == self.part else ~met
        open_ &= (self.sizes != 1)[None, :] | (self.ids[self.first][None, :] != name[:, None])
        row, col, dist = _nearest(x.astype(np.float64), self.x, open_, k)
        size = self.sizes[col]
        at = np.repeat(self.first[col] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        row, dist, ids, n = np.repeat(row, size), np.repeat(dist, size), self.ids[at], self.n[at]
        order = np.lexsort((ids, dist, row))
        order = order[ids[order] != name[row[order]]]
        row = row[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        order, row = order[kept], row[kept]
        return pa.RecordBatch.from_pydict({
            "query": pa.array(name[row]), "qkey": pa.array(key[row]), "vec_id": pa.array(ids[order]), "n": pa.array(n[order]), "dist": pa.array(dist[order]),
        })


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Streams cells in order: the rows of one, at most some ``CELL_ROWS``, then its queries."""
    at, blocks, cell = None, [], None
    for batch in batches:
        where = [np.asarray(batch.column(c), dtype=np.int64) for c in ("dims", "part", "cell", "salt")]
        asks = np.asarray(batch.column("asks"))
        code, radius, name, key = (np.asarray(batch.column(c)) for c in ("code", "radius", "query", "qkey"))
        code = code.view(np.uint64)
        flat, of = np.asarray(batch.column("x").flatten()), np.cumsum(where[0]) - where[0]
        ids, sizes = batch.column("ids"), np.asarray(pa.compute.list_value_length(batch.column("ids")), dtype=np.int64)
        inner, begin = ids.flatten(), np.cumsum(sizes) - sizes
        vec_id, n = np.asarray(inner.field("vec_id")), np.asarray(inner.field("n"))
        for a, b in zip(*runs(*where, asks)):
            here = tuple(int(w[a]) for w in where)
            if here != at:
                at, blocks, cell = here, [], None
            x = flat[of[a] : of[a] + (b - a) * here[0]].reshape(b - a, here[0])
            if not asks[a]:
                part = slice(begin[a], begin[a] + int(sizes[a:b].sum()))
                blocks.append((code[a:b], x, sizes[a:b], vec_id[part], n[part]))
                continue
            if not blocks:
                continue
            cell = cell or _Cell(here[1], blocks)
            for i in range(0, b - a, QUERY_ROWS):
                q = slice(a + i, min(b, a + i + QUERY_ROWS))
                yield cell.answer(name[q], key[q], code[q], x[i : i + QUERY_ROWS], radius[q], k)


def within(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """(query, qkey, rank, vec_id, dist): the k nearest of all rows whose codes lie within a query's radius.

    ``queries`` has query, qkey, code, dims, x and radius. Each task streams cells, so it holds
    one block of rows and one of queries; cells that no query touches are not moved.
    """
    spark, p = index.table.sparkSession, index.prefix
    kind = queries.schema["x"].dataType.simpleString()
    plain = queries.select("query", "qkey", "code", "dims", "x", F.col("radius").cast("int").alias("radius"))
    probes = plain.mapInArrow(lambda it: _probe(it, p), f"query long, qkey long, code long, dims int, x {kind}, radius int, part int, cell int")
    probes = settle(probes.join(index.cells, ["dims", "part", "cell"]), "vector-probes")
    used = probes.select("dims", "part", "cell").distinct().join(index.cells, ["dims", "part", "cell"])
    parts = F.explode(F.array(*[F.struct(F.lit(j).alias("part"), substring(F.col("code"), j, p).alias("cell")) for j in range(PARTS)]))
    rows = index.table.select("*", parts.alias("p")).select("code", "dims", "x", "ids", "p.part", "p.cell").join(used, ["dims", "part", "cell"])
    none = F.lit(0).cast("long")
    rows = rows.select("dims", "part", "cell", F.pmod(F.xxhash64(F.lit("salt"), "x"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("asks"), none.alias("query"), none.alias("qkey"), "code", "x", "ids", F.lit(0).alias("radius"))
    salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    nobody = F.array().cast(index.table.schema["ids"].dataType)
    asked = probes.select("dims", "part", "cell", salt, F.lit(True).alias("asks"), "query", "qkey", "code", "x", nobody.alias("ids"), "radius")
    order = ["dims", "part", "cell", "salt"]
    dealt = rows.unionByName(asked).repartition(pieces(spark), *order).sortWithinPartitions(*order, "asks")
    found = dealt.mapInArrow(lambda it: _search(it, k), "query long, qkey long, vec_id long, n long, dist double")
    copies = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    place = F.row_number().over(Window.partitionBy("query", "qkey").orderBy("dist", "vec_id"))
    return copies.withColumn("rank", place).where(F.col("rank") <= k).select("query", "qkey", "rank", "vec_id", "dist")


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` with vec_id and x: the k nearest found."""
    kind = queries.schema["x"].dataType.simpleString()
    named = queries.select(F.col("vec_id").alias("query"), "x").withColumn("qkey", F.xxhash64("x")).dropDuplicates(["query", "qkey"])
    names, codes = ["query", "qkey", "x"], index.codes
    coded = named.mapInArrow(lambda it: _encode(it, codes, names), f"code long, dims int, query long, qkey long, x {kind}")
    asked = settle(coded, "vector-queries")
    first = settle(within(index, asked.withColumn("radius", F.lit(index.calibration.first)), k), "vector-found")
    last = first.where(F.col("rank") == k).select("query", "qkey", F.col("dist").alias("reach"))
    wanted = asked.join(last, ["query", "qkey"], "left").withColumn("radius", index.calibration.radius(F.col("reach")))
    again = wanted.where(F.col("radius") > index.calibration.first)
    second = within(index, again, k)
    kept = first.join(again.select("query", "qkey"), ["query", "qkey"], "left_anti")
    return kept.unionByName(second).select(F.col("query").alias("query_id"), "rank", "vec_id", F.col("dist").alias("score"))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The ``k`` nearest found of every ``every``-th vector: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding; other columns are ignored. Queries are the rows whose
    vec_id is divisible by ``every``. The score is the Euclidean distance in double precision;
    ties go to the smaller vec_id. Which rows are found is approximate, their scores are exact.

    - Vectors that ``usable`` leaves out take no part, neither as query nor as candidate.
    - Vectors of different lengths have no distance. Codes of a length that the sample lacks
      come from a random rotation.
    - Rows that share the query's vec_id are its own and no candidates. A query repeated in
      full is one query; repeated candidates come as often as their rows.
    - A query that finds fewer than ``k`` within its first radius looks through all codes, so
      fewer than ``k`` rows come back only where there are no more. An empty table gives none.
    - Equal vectors are one entry of the index, whatever their number.
    """
    ready(vectors.sparkSession)
    asked = usable(vectors.where(F.col("vec_id") % every == 0))
    return search(build_index(vectors, k), asked, k)

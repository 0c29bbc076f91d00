"""Exact nearest neighbours: cells around pivots, pruned by bounds on their distance.

Each row belongs to the cell of its nearest pivot. The k-th distance to rows of its own cell
bounds how far its neighbours can be, and a cell is searched only if the triangle inequality,
the plane between the two pivots and the cell's box all leave room within that bound (compare
Lu et al., 2012). Cells near each other share a shelf, so a row travels once per shelf, not
once per cell; inside a shelf it meets only the cells that its bound leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.session import settle

# rows a cell should hold, while there are fewer pivots than PIVOTS
CELL_ROWS = 512
# pivots of all groups, about: they and the boxes of their cells go to every task
PIVOTS = 4_096
# rows a shelf holds; a cell with more is cut into pieces by hash, each a shelf
LEAST_SHELF_ROWS, SHELF_ROWS = 2_048, 32_768
# rows that look through a shelf in one task
VISITORS = 8_192
# rows whose distances to others are held at once
STEP = 1_024
# the rounding error of single precision, in units of what is allowed for double precision
_SINGLE = 1.2e7
# pairs of a row and a cell that are looked at together: 4 MB for each number of a pair
ROOM = 1 << 19

_CELLED = "grp int, id bigint, ids array<bigint>, x array<double>, cell int, away double"
_BOUND = "grp int, id bigint, ids array<bigint>, x array<double>, cell int, reach double, home int, shelves array<int>"
_NEAR = "grp int, id bigint, dist double, ids array<bigint>"


def fast_distances(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by one matrix product, and a bound on their rounding error."""
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    fast = x @ y.T
    fast *= -2.0
    fast += xx[:, None] + yy[None, :]  # as the difference, to the bit, with half the memory
    return fast, _rounding(x.shape[1], float(xx.max() + yy.max()))


def _rounding(width: int, norms: float) -> float:
    return 1e-14 * (width + 8) * norms


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, coordinate by coordinate, so reruns agree to the bit."""
    dist = np.zeros(len(x))
    for d in range(x.shape[1]):
        step = x[:, d] - y[:, d]
        dist += step * step
    return dist


def closest(ids, x, others, y, k: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other, squared distance) of the k closest ``others`` to each of ``ids``.

    By exact distance, then by id, and none to itself; none beyond ``reach`` where it is
    given. Fast distances only rule out rows too far to matter, with room for their rounding
    error.
    """
    fast, bound = fast_distances(x, y)
    fast[ids[:, None] == others[None, :]] = np.inf
    limit = np.full(len(ids), np.inf) if reach is None else reach * reach * (1 + 1e-12) + bound
    if reach is None and fast.shape[1] > k:
        limit = np.partition(fast, k - 1, axis=1)[:, k - 1] + 2.0 * bound
    row, col = np.nonzero((fast <= limit[:, None]) & np.isfinite(fast))
    return _first(row, col, _exact(x[row], y[col]), others[col], k)


def _first(row, col, dist, other, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k of each row by distance, then by id."""
    order = np.lexsort((other, dist, row))
    row, col, dist = row[order], col[order], dist[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], col[kept], dist[kept]


class Shelf:
    """Rows that others visit, with half their squared norm as one more coordinate.

    The product with a visitor, whose last coordinate is -1, then falls as the distance grows: it
    is compared with one number per visitor, and nothing else is done to all pairs. Products are
    of single precision and from the shelf's middle, so what they leave open is small; rows that
    they don't rule out are compared exactly.
    """

    def __init__(self, y: np.ndarray, others: np.ndarray):
        self.middle, self.others = y.mean(axis=0), others
        self.raw = float((y * y).sum(1).max())  # what the doubles that are rounded from were like
        centred = y - self.middle
        norms = (centred * centred).sum(1)
        self.y, self.norm = np.column_stack([centred, 0.5 * norms]), float(norms.max())
        self.single = self.y.astype(np.float32)

    def visit(self, ids: np.ndarray, x: np.ndarray, reach: np.ndarray, k: int) -> Visit:
        return Visit(self, ids, x, reach, k)


class Visit:
    """Some visitors of a shelf: what they have met so far that may be among their k closest."""

    def __init__(self, shelf: Shelf, ids: np.ndarray, x: np.ndarray, reach: np.ndarray, k: int):
        self.shelf, self.ids, self.k = shelf, ids, k
        raw = float((x * x).sum(1).max())
        centred = x - shelf.middle
        norms = (centred * centred).sum(1)
        self.x, self.half = np.column_stack([centred, np.full(len(x), -1.0)]), 0.5 * norms
        # the halved norm is one coordinate more, and as large as the others together
        both = float(norms.max()) + shelf.norm
        double, single = (2.0 * _rounding(x.shape[1] + 1, n) for n in (both + raw + shelf.raw, both * _SINGLE))
        square = reach * reach
        # where single precision may not tell near from far, or would overflow, doubles are used
        middle = float(np.median(square))
        self.y = shelf.single if both < 1e30 and np.isfinite(middle) and single <= 0.1 * middle else shelf.y
        self.bound = double + single if self.y is shelf.single else double
        self.x = self.x.astype(self.y.dtype)
        self.limit = square * (1 + 1e-12) + self.bound
        self.row, self.col, self.fast = np.zeros(0, int), np.zeros(0, int), np.zeros(0)

    def meet(self, rows: np.ndarray, held: slice) -> None:
        """Compares the visitors ``rows`` with a run of the shelf."""
        near = self.x[rows] @ self.y[held].T
        least = self.half[rows] - 0.5 * self.limit[rows]
        if near.dtype == np.float32:  # at most the number itself, so that the comparison stays in single precision
            least = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
        at = np.flatnonzero(near >= least[:, None])
        row, col = np.divmod(at, near.shape[1])
        fast = 2.0 * (self.half[rows[row]] - near.ravel()[at].astype(np.float64))
        row, col = rows[row], held.start + col
        new = self.ids[row] != self.shelf.others[col]
        self.row = np.concatenate([self.row, row[new]])
        self.col = np.concatenate([self.col, col[new]])
        self.fast = np.concatenate([self.fast, fast[new]])
        if len(self.row) > 4 * self.k * len(self.ids):
            self._tighten()

    def _tighten(self) -> None:
        """k rows that were met bound the distance of any that still matters."""
        order = np.lexsort((self.fast, self.row))
        self.row, self.col, self.fast = self.row[order], self.col[order], self.fast[order]
        nth = np.arange(len(self.row)) - np.searchsorted(self.row, self.row)
        last = nth == self.k - 1
        self.limit[self.row[last]] = np.minimum(self.limit[self.row[last]], self.fast[last] + 2.0 * self.bound)
        kept = self.fast <= self.limit[self.row]
        self.row, self.col, self.fast = self.row[kept], self.col[kept], self.fast[kept]

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """(visitor, place on the shelf) of all that may be among a visitor's k closest here."""
        self._tighten()
        return self.row, self.col


@dataclass
class Cells:
    """Pivots with the extent of their cells, and the shelves that hold them. At most about PIVOTS."""

    grp: np.ndarray
    pivot: np.ndarray
    norm: float  # largest squared norm of a row
    radius: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    shelf: np.ndarray | None = None  # the first shelf of the cell
    pieces: np.ndarray | None = None  # how many it has

    @property
    def error(self) -> float:
        return _rounding(self.pivot.shape[1], 2.0 * self.norm)

    def squares(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return np.maximum(fast_distances(x, self.pivot[cells])[0], 0.0)

    def place(self, grp: int, x: np.ndarray) -> np.ndarray:
        """The cell of each row: its nearest pivot within the group."""
        cells = np.flatnonzero(self.grp == grp)
        step = _step(len(cells))
        return np.concatenate(
            [cells[np.argmin(self.squares(x[at : at + step], cells), axis=1)] for at in range(0, len(x), step)]
        )

    def leave_room(self, x: np.ndarray, own: np.ndarray, reach: np.ndarray, cells: np.ndarray, boxes: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in ``cells``) where a row of the cell may lie within ``reach``.

        Every bound gives way by the rounding error of the distances that it is made of.
        """
        square = self.squares(x, cells)
        slack = max(np.sqrt(self.error), 1e-150)
        limit = reach * (1 + 1e-12) + slack
        room = np.sqrt(square) - self.radius[cells][None, :] - 2 * slack <= limit[:, None]
        to_own = ((x - self.pivot[own]) ** 2).sum(1)
        apart = np.sqrt(np.maximum(fast_distances(self.pivot[own], self.pivot[cells])[0], 0.0))
        # rows of the cell are nearer to its pivot than to this row's, so a plane lies between
        room &= square - to_own[:, None] - 6 * self.error <= 2 * (apart + slack) * limit[:, None]
        row, col = np.nonzero(room)
        if not boxes:
            return row, col
        gap = np.zeros(len(row))
        for d in range(x.shape[1]):
            v, c = x[row, d], cells[col]
            gap += np.maximum(np.maximum(self.low[c, d] - v, v - self.high[c, d]), 0.0) ** 2
        near = np.sqrt(gap) <= limit[row]
        return row[near], col[near]


def _step(cells: int) -> int:
    """How many rows are compared with so many cells at once."""
    return max(1, min(STEP, ROOM // max(1, cells)))


def _in_halves(at: np.ndarray, pivot: np.ndarray) -> list[int]:
    """Pivots in an order that keeps near ones together: halved along the widest coordinate."""
    if len(at) <= 2:
        return [int(a) for a in at]
    axis = int(np.argmax(np.ptp(pivot[at], axis=0)))
    at = at[np.argsort(pivot[at, axis], kind="stable")]
    return _in_halves(at[: len(at) // 2], pivot) + _in_halves(at[len(at) // 2 :], pivot)


def _shelve(cells: Cells, sizes: np.ndarray, shelf_rows: int) -> None:
    cells.shelf, cells.pieces = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    shelf, held = 0, 0
    for g in np.unique(cells.grp):
        for c in _in_halves(np.flatnonzero(cells.grp == g), cells.pivot):
            if held and held + sizes[c] > shelf_rows:
                shelf, held = shelf + 1, 0
            cells.shelf[c] = shelf
            cells.pieces[c] = max(1, -(-int(sizes[c]) // shelf_rows))
            held += int(sizes[c])
            if cells.pieces[c] > 1:
                shelf, held = shelf + int(cells.pieces[c]), 0
        shelf, held = shelf + 1, 0


def _fit_pivots(points: DataFrame, rows: int, norm: float) -> Cells:
    """Pivots drawn by a hash of the id: about one per CELL_ROWS rows, and one per group at least."""
    share = min(1.0, min(PIVOTS, -(-rows // CELL_ROWS)) / rows)
    digest = F.pmod(F.xxhash64(F.lit("pivot"), "id"), F.lit(1 << 30))
    drawn = points.where(digest < int(share * (1 << 30))).select("grp", "id", "x")
    each = points.groupBy("grp").agg(F.min_by(F.struct("id", "x"), F.struct(digest, "id")).alias("p"))
    found = sorted(
        {(r["grp"], r["id"]): r["x"] for r in drawn.unionByName(each.select("grp", "p.id", "p.x")).collect()}.items()
    )
    return Cells(np.array([g for (g, _), _ in found]), np.array([x for _, x in found], dtype=float), norm)


def _merged(points: DataFrame, k: int) -> DataFrame:
    """(grp, id, ids, x): one row per different point, with the lowest k + 1 ids that lie there."""
    lowest = F.row_number().over(Window.partitionBy("grp", "x").orderBy("id"))
    few = points.select("grp", "id", "x").withColumn("_n", lowest).where(F.col("_n") <= k + 1)
    return few.groupBy("grp", "x").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        "grp", F.col("ids")[0].alias("id"), "ids", "x"
    )


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy())


def _piece(ids: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % pieces.astype(np.uint64)).astype(np.int64)


def _bounded(celled: DataFrame, parts: DataFrame, cells, k: int) -> DataFrame:
    """Each point with a bound on its k-th distance and the shelves within that bound.

    ``parts`` cuts the fullest cells by hash: any k others of the cell give a bound.
    """

    def bound(rows: pd.DataFrame) -> pd.DataFrame:
        known = cells.value
        rows = rows.sort_values("id", ignore_index=True)
        ids, x, own = rows["id"].to_numpy(), _matrix(rows["x"]), rows["cell"].to_numpy()
        among = np.flatnonzero(known.grp == rows["grp"].iloc[0])
        reach, shelves = np.full(len(ids), np.inf), []
        shelf_count = int((known.shelf + known.pieces).max())
        for at in range(0, len(ids), STEP):
            part = slice(at, at + STEP)
            row, _, dist = closest(ids[part], x[part], ids, x, k)
            last = np.flatnonzero(np.bincount(row, minlength=len(ids[part])) == k)
            reach[at + last] = np.sqrt(dist[np.searchsorted(row, last, side="right") - 1])
        step = _step(len(among))
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            row, col = known.leave_room(x[part], own[part], reach[part], among)
            cell = among[col]
            pieces = known.pieces[cell]
            row, first = np.repeat(row, pieces), np.repeat(known.shelf[cell], pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            visited = np.zeros((len(ids[part]), shelf_count), dtype=bool)
            visited[row, first + nth] = True
            row, shelf = np.nonzero(visited)
            shelves += np.split(shelf.astype(np.int32), np.searchsorted(row, np.arange(1, len(visited))))
        home = known.shelf[own] + _piece(ids, known.pieces[own])
        return rows[["grp", "id", "ids", "x", "cell"]].assign(reach=reach, home=home, shelves=shelves)

    cut = celled.join(F.broadcast(parts), "cell")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")
    return cut.groupBy("grp", "cell", part).applyInPandas(bound, _BOUND)


def _searched(bounded: DataFrame, cells, k: int) -> DataFrame:
    """(grp, id, dist, ids): candidates of each point from every shelf that it visits."""
    # one row per shelf, that is per 2,048 rows at the most
    salts = bounded.select(F.explode("shelves").alias("shelf")).groupBy("shelf").agg(
        F.ceil(F.count("*") / F.lit(VISITORS)).cast("int").alias("salts")
    )
    none = F.lit(None)
    visitors = bounded.select("grp", "id", none.cast("array<bigint>").alias("ids"), "x", "cell", "reach", F.explode("shelves").alias("shelf"))
    visitors = visitors.join(salts, "shelf").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    held = bounded.select("grp", "id", "ids", "x", "cell", none.cast("double").alias("reach"), F.col("home").alias("shelf"))
    held = held.join(salts, "shelf").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        known = cells.value
        here = rows["reach"].isna().to_numpy()
        out = [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
        # visitors of one cell look at the same cells, so they go together
        held, seen = (rows[of].sort_values(["cell", "id"], ignore_index=True) for of in (here, ~here))
        if len(held) and len(seen):
            y, others, cell = _matrix(held["x"]), held["id"].to_numpy(), held["cell"].to_numpy()
            x, ids, own, reach = _matrix(seen["x"]), seen["id"].to_numpy(), seen["cell"].to_numpy(), seen["reach"].to_numpy()
            here_cells = np.unique(cell)
            ends = np.append(np.searchsorted(cell, here_cells), len(cell))
            shelf, found = Shelf(y, others), []
            for at in range(0, len(ids), STEP):
                part = slice(at, at + STEP)
                row, col = known.leave_room(x[part], own[part], reach[part], here_cells, boxes=False)
                visit = shelf.visit(ids[part], x[part], reach[part], k)
                for c in np.unique(col):
                    for low in range(ends[c], ends[c + 1], STEP):
                        visit.meet(row[col == c], slice(low, min(ends[c + 1], low + STEP)))
                r, o = visit.candidates()
                found.append((at + r, o, _exact(x[at + r], y[o])))
            row, col, dist = (np.concatenate(p) for p in zip(*found))
            out = _first(row, col, dist, others[col], k)
        row, col, dist = out
        return pd.DataFrame(
            {"grp": rows["grp"].iloc[0], "id": seen["id"].to_numpy()[row], "dist": dist, "ids": held["ids"].to_numpy()[col]}
        )

    both = visitors.drop("salts").unionByName(held.drop("salts"))
    return both.groupBy("shelf", "salt").applyInPandas(search, _NEAR)


def nearest(points: DataFrame, k: int) -> DataFrame:
    """The exact k nearest others of each row in its group, as (grp, id, place, neighbour).

    ``points`` has grp, a unique id and x, an array of one length without nulls; ties go to
    the lower id. Equal rows are one point to the search, whose lowest k + 1 ids stand for all,
    so copies add no comparisons. A group with fewer than k others gives all of them, and an
    empty table gives none. Groups are few: clusters, or one.

    Work follows how far the bounds reach, which the data decide: on a few coordinates a row
    meets some cells, on many independent ones most of them.
    """
    spark = points.sparkSession
    merged = settle(_merged(points, k), "id")
    norms = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    rows, norm = merged.agg(F.count("*"), F.max(norms)).first()
    if not rows:
        return spark.createDataFrame([], "grp int, id bigint, place int, neighbour bigint")
    cells = _fit_pivots(merged, rows, norm)
    pivots = spark.sparkContext.broadcast(cells)

    def place(batches):
        for pdf in batches:
            for g, part in pdf.groupby("grp"):
                x = _matrix(part["x"])
                cell = pivots.value.place(int(g), x)
                away = np.sqrt(_exact(x, pivots.value.pivot[cell]))
                yield part.assign(cell=cell, away=away)[["grp", "id", "ids", "x", "cell", "away"]]

    celled = settle(merged.mapInPandas(place, _CELLED), "id")
    parts, known = _extents(celled, cells, rows)
    bounded = settle(_bounded(celled, parts, known, k), "id")
    near = _searched(bounded, known, k).select("grp", "id", "dist", F.explode("ids").alias("member"))
    own = merged.select("grp", "id", F.lit(0.0).alias("dist"), F.explode("ids").alias("member"))
    place_ = F.row_number().over(Window.partitionBy("grp", "id").orderBy("dist", "member"))
    first = near.unionByName(own).withColumn("place", place_).where(F.col("place") <= k + 1)
    listed = first.groupBy("grp", "id").agg(F.sort_array(F.collect_list(F.struct("place", "member"))).alias("near"))
    by_x = merged.select("grp", "id", "x").join(listed, ["grp", "id"]).select("grp", "x", "near")
    others = F.slice(F.filter("near", lambda m: m["member"] != F.col("id")), 1, k)
    return points.select("grp", "id", "x").join(by_x, ["grp", "x"]).select(
        "grp", "id", F.posexplode(others).alias("place", "m")
    ).select("grp", "id", (F.col("place") + 1).alias("place"), F.col("m.member").alias("neighbour"))


def _extents(celled: DataFrame, cells: Cells, rows: int) -> tuple[DataFrame, object]:
    """(cell, parts) and the cells with radius, box and shelves, broadcast: a row per cell."""
    spark, width = celled.sparkSession, cells.pivot.shape[1]
    found = celled.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("away").alias("radius"),
        F.array(*[F.min(F.col("x")[d]) for d in range(width)]).alias("low"),
        F.array(*[F.max(F.col("x")[d]) for d in range(width)]).alias("high"),
    ).collect()
    count = len(cells.grp)
    sizes, cells.radius = np.zeros(count, dtype=np.int64), np.zeros(count)
    cells.low, cells.high = np.full((count, width), np.inf), np.full((count, width), -np.inf)
    for r in found:
        c = r["cell"]
        sizes[c], cells.radius[c], cells.low[c], cells.high[c] = r["n"], r["radius"], r["low"], r["high"]
    spread = rows // (4 * spark.sparkContext.defaultParallelism)
    _shelve(cells, sizes, min(SHELF_ROWS, max(LEAST_SHELF_ROWS, spread)))
    parts = [(c, max(1, -(-int(n) // (4 * CELL_ROWS)))) for c, n in enumerate(sizes)]
    return spark.createDataFrame(parts, "cell int, parts int"), spark.sparkContext.broadcast(cells)

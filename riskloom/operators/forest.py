"""Random forests for a whole grid from one growth, cross-validated.

Trees are grown to the end once, for the rows of every fold and for all rows. A smaller number
of trees is a prefix of the forest, and a smaller depth a cut of its trees, since inner nodes
keep their class counts. So the six points of the usual grid cost one growth.

Every draw is a hash: a row's weight in a tree (Poisson, as a bootstrap of many rows has it) of
tree and key, a node's features of its place in the tree. A split follows from whole-number
histograms alone. Nodes with many rows sum theirs over all tasks, level by level; once a node
is down to ``LOCAL_ROWS`` one task grows the rest of the subtree by the same rule. Such a task
takes some nodes of one tree, in all folds, reads the packed rows and keeps those that lie in
them: a row would else be written once for each tree and fold. Where that happens changes
nothing in the tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import settle

BINS = 32
LOCAL_ROWS = 1_000_000
HELD_NODES = 16_384  # nodes whose histograms a task holds: 3 KB for each at 6 drawn features
UNITS = 200  # tasks that one job grows with
PACK_ROWS = 16_384  # rows of a packed block
RUN_ROWS = 32_768  # rows of a level that are looked at together
ALL = -1  # the fold of the forest that no row is held out from
SCORE_ROWS = 16_384  # rows that go through a tree together
GROUP_NODES = 1_000_000  # nodes of the trees that one task scores with
UNIT = 1 << 40  # class shares are summed as whole numbers, so their order doesn't count
_CLASS_BITS = 26  # a row's weight counts once, and 2^26 times again in class 1: one sum holds both
_CLASS_SUMS = 1 << _CLASS_BITS
_CLASS = float(_CLASS_SUMS)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: P(Poisson(1) <= k) in units of 2^-32, for k = 0, 1, ...
_POISSON = np.floor(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)])) * 2.0**32).astype(np.uint64)

_NODE = np.dtype([("key", "<u8"), ("left", "<u8"), ("right", "<u8"), ("n0", "<i8"), ("n1", "<i8"), ("gain", "<f8"), ("feature", "<i2"), ("cut", "<i2"), ("depth", "<i4")])
_PACKS = "fold int, tree int, nodes long, pack binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def root_key(seed: int, tree: int) -> np.uint64:
    return _mix(np.asarray([(seed << 32) + tree + 1], dtype=np.uint64) * _GOLD)[0] | np.uint64(1)


def child_keys(key: np.ndarray, side: int) -> np.ndarray:
    return _mix(key * _GOLD + np.uint64(side + 1)) | np.uint64(1)


def weights(seed: int, tree: int, ids: np.ndarray) -> np.ndarray:
    """How often each row is in the tree's bootstrap."""
    draw = _mix(ids.astype(np.uint64) * _GOLD + root_key(seed, tree)) >> np.uint64(32)
    return np.searchsorted(_POISSON, draw, side="right").astype(np.int64)


def feature_order(keys: np.ndarray, size: int) -> np.ndarray:
    """All features for each node, in the order it draws them."""
    return np.argsort(_draws(keys, size), axis=1, kind="stable")


def _draws(keys: np.ndarray, size: int) -> np.ndarray:
    return _mix(keys[:, None] + np.arange(1, size + 1, dtype=np.uint64) * _GOLD)


def _first_features(keys: np.ndarray, size: int, tries: int) -> np.ndarray:
    """The first features of that order. Draws that differ only in the bits that hold the place would matter."""
    bits = np.uint64(max(1, int(size - 1).bit_length()))
    draws = _draws(keys, size)
    places = np.arange(size, dtype=np.uint64)
    packed = (draws >> bits << bits) | places
    packed.sort(axis=1)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    near = ((packed[:, 1:tries + 1] ^ packed[:, : min(tries, size - 1)]) >> bits == 0).any(axis=1)
    first = (packed[:, :tries] & mask).astype(np.int64)
    if near.any():
        first[near] = feature_order(keys[near], size)[:, :tries]
    return first


# --- splitting ----------------------------------------------------------------------------


def histograms(bins: np.ndarray, y: np.ndarray, w: np.ndarray, node: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Weighted counts by node, drawn feature, bin and class."""
    nodes, drawn = order.shape
    at = ((node[:, None] * drawn + np.arange(drawn)) * BINS + np.take_along_axis(bins, order[node], axis=1)) * 2 + y[:, None]
    flat = np.bincount(at.ravel(), np.repeat(w, drawn), nodes * drawn * BINS * 2)
    return flat.reshape(nodes, drawn, BINS, 2).astype(np.int64)


def best_splits(counts: np.ndarray, order: np.ndarray, tries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, gain) of each node by Gini, rows with bin <= cut to the left.

    The first ``tries`` drawn features compete. Where all of them are constant the next one
    that varies is taken, if it is among ``counts``. Feature -1: no split there. Ties go to the
    feature drawn first, then to the lower cut.
    """
    left = np.cumsum(counts, axis=2)[:, :, :-1].astype(np.float64)
    total = counts.sum(axis=2, keepdims=True).astype(np.float64)
    right = total - left
    n_left, n_right, n = left.sum(-1), right.sum(-1), total.sum(-1)
    possible = (n_left > 0) & (n_right > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (left**2).sum(-1) / n_left + (right**2).sum(-1) / n_right - (total**2).sum(-1) / n
    purity = np.where(possible, purity, -np.inf)
    cut = purity.argmax(axis=2)
    return _compete(np.take_along_axis(purity, cut[:, :, None], axis=2)[:, :, 0], cut, order, tries)


def _compete(best: np.ndarray, cut: np.ndarray, order: np.ndarray, tries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The drawn feature that each node splits by, from the best cut of each."""
    drawn, varies = np.arange(best.shape[1]), np.isfinite(best)
    first = np.where(varies.any(axis=1), varies.argmax(axis=1), -1)
    competes = (drawn < tries) | (drawn == first[:, None])
    competes &= (first < tries)[:, None] & (drawn < tries) | (drawn == first[:, None])
    best = np.where(competes, best, -np.inf)
    chosen = best.argmax(axis=1)
    rows = np.arange(len(best))
    found = first >= 0
    return np.where(found, order[rows, chosen], -1), cut[rows, chosen], np.where(found, best[rows, chosen], 0.0)


def row_splits(bins: np.ndarray, y: np.ndarray, w: np.ndarray, node: np.ndarray, order: np.ndarray, tries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_splits`` of rows in hand, where every node has some, looking only at bins that hold rows.

    An empty bin cuts as the one below it does, which comes first. So a level costs what its rows
    cost, and not its nodes times their bins.
    """
    return _splits(bins, _both(y, w), node, order, tries)


def _both(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Each row's weight, once for all rows and once for those of class 1, as one number."""
    return w + w * y * _CLASS


def _apart(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weights of the rows of class 0 and of class 1 in such a sum of whole numbers."""
    one = both >> _CLASS_BITS
    return ((both & (_CLASS_SUMS - 1)) - one).astype(np.float64), one.astype(np.float64)


def _splits(bins: np.ndarray, both: np.ndarray, node: np.ndarray, order: np.ndarray, tries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nodes, drawn = order.shape
    # a slot is a feature drawn by a node, a cell a bin of it
    at = bins.ravel().take(order.take(node, axis=0) + np.arange(0, bins.size, bins.shape[1])[:, None])
    at = at + np.arange(0, nodes * drawn * BINS, BINS).reshape(nodes, drawn).take(node, axis=0)
    sums = np.bincount(at.ravel(), np.repeat(both, drawn), nodes * drawn * BINS)
    cell = np.flatnonzero(sums > 0)
    sums, slot = sums.take(cell).astype(np.int64), cell // BINS
    inner = slot[:-1] == slot[1:]  # a slot's last cell cuts nothing off
    ends = np.append(np.flatnonzero(~inner), len(cell) - 1)
    upto = np.cumsum(sums)
    whole_sums = np.diff(upto.take(ends), prepend=0)
    inner = np.flatnonzero(inner)
    best, cut = np.full(nodes * drawn, -np.inf), np.zeros(nodes * drawn, dtype=np.int64)
    if len(inner):
        slot, cell = slot.take(inner), cell.take(inner)
        all_zero, all_one = _apart(whole_sums)
        n = all_zero + all_one
        whole = (all_one**2 + all_zero**2) / n
        zero, one = _apart(upto.take(inner) - (upto.take(ends) - whole_sums).take(slot))
        n_left = zero + one
        n_right = n.take(slot) - n_left
        purity = (zero * zero + one * one) / n_left
        np.subtract(all_zero.take(slot), zero, out=zero)
        np.subtract(all_one.take(slot), one, out=one)
        purity += (zero * zero + one * one) / n_right
        purity -= whole.take(slot)
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        varies = slot.take(first)
        top = np.maximum.reduceat(purity, first)
        best[varies] = top
        hits = np.flatnonzero(purity == best.take(slot))
        cut[varies] = cell.take(hits.take(np.searchsorted(hits, first))) % BINS
    return _compete(best.reshape(nodes, drawn), cut.reshape(nodes, drawn), order, tries)


def _level_splits(bins: np.ndarray, both: np.ndarray, ends: np.ndarray, keys: np.ndarray, tries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The splits of nodes whose rows lie together, node i's up to ``ends[i]``.

    They are looked at some ten thousand rows at a time, so that little memory is held at once.
    """
    found, at, low = [], 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, low + RUN_ROWS, side="right")))
        high = int(ends[to - 1])
        part, own = slice(low, high), bins[low:high]
        node = np.repeat(np.arange(to - at), np.diff(ends[at:to], prepend=low))
        feature, cut, gain = _splits(own, both[part], node, _first_features(keys[at:to], bins.shape[1], tries), tries)
        stuck = np.flatnonzero(feature < 0)
        if len(stuck):  # every drawn feature is constant there: look at all of them
            among = np.full(to - at, -1)
            among[stuck] = np.arange(len(stuck))
            rows = among[node] >= 0
            order = feature_order(keys[at:to][stuck], bins.shape[1])
            feature[stuck], cut[stuck], gain[stuck] = _splits(own[rows], both[part][rows], among[node[rows]], order, tries)
        found.append((feature, cut, gain))
        at, low = to, high
    return tuple(np.concatenate(v) for v in zip(*found))


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, root: np.uint64, depth: int, tries: int, deepest: int | None) -> np.ndarray:
    """The nodes of a subtree, level by level over all its nodes at once; a node's rows lie together."""
    keys, ends, both = np.asarray([root], dtype=np.uint64), np.asarray([len(y)]), _both(y, w)
    out = []
    while len(keys):
        made = np.zeros(len(keys), dtype=_NODE)
        made["key"], made["depth"], made["feature"] = keys, depth, -1
        sizes = np.diff(ends, prepend=0)
        made["n0"], made["n1"] = _apart(np.add.reduceat(both, ends - sizes).astype(np.int64))
        open_ = (made["n0"] > 0) & (made["n1"] > 0) if deepest is None or depth < deepest else np.zeros(len(keys), dtype=bool)
        out.append(made)
        if not open_.any():
            break
        if not open_.all():
            rows = np.repeat(open_, sizes)
            bins, both, keys, sizes = bins[rows], both[rows], keys[open_], sizes[open_]
        ends = np.cumsum(sizes)
        feature, cut, gain = _level_splits(bins, both, ends, keys, tries)
        split = feature >= 0
        target = made[open_]
        target["feature"], target["cut"], target["gain"] = feature, np.where(split, cut, 0), gain
        children = np.stack([child_keys(keys, 0), child_keys(keys, 1)], axis=1)
        target["left"], target["right"] = np.where(split, children.T, 0)
        made[open_] = target
        if not split.all():
            rows = np.repeat(split, sizes)
            bins, both, sizes, feature, cut = bins[rows], both[rows], sizes[split], feature[split], cut[split]
        if not len(sizes):
            break
        low = np.cumsum(sizes) - sizes
        value = bins.ravel().take(np.arange(len(both)) * bins.shape[1] + np.repeat(feature, sizes))
        left = value <= np.repeat(cut, sizes)
        lefts = np.add.reduceat(left, low, dtype=np.int64)
        # each row goes on to the rows of its side of its node
        so_far = np.cumsum(left)
        rank = so_far - np.repeat(so_far[low] - left[low], sizes)  # rows to the left up to this one
        place = np.arange(len(both)) - rank + np.repeat(lefts, sizes)
        place = np.where(left, np.repeat(low, sizes) + rank - 1, place)
        target_rows = np.empty(len(both), dtype=np.int64)
        target_rows[place] = np.arange(len(both))
        bins, both = bins[target_rows], both[target_rows]
        ends = np.cumsum(np.stack([lefts, sizes - lefts], axis=1).ravel())
        keys = children[split].ravel()
        depth += 1
    return np.concatenate(out)


# --- binned rows --------------------------------------------------------------------------


@dataclass(frozen=True)
class Binning:
    """Upper bounds of the bins of each feature."""

    bounds: list[list[float]]

    def transform(self, df: DataFrame, keep: Sequence[str], source: str) -> DataFrame:
        bounds = [np.asarray(b) for b in self.bounds]
        names = list(keep)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.asarray(batch.column("__x").flatten(), dtype=np.float64).reshape(batch.num_rows, len(bounds))
                bins = np.empty(x.shape, dtype=np.uint8)
                for i, b in enumerate(bounds):
                    bins[:, i] = np.searchsorted(b, x[:, i])
                packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.py_buffer(bins.tobytes())])
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), packed], [*names, "bins"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema)
        return df.select(*names, vector_to_array(source).alias("__x")).mapInArrow(cut, f"{schema}, bins binary")


def fit_bins(train: DataFrame, source: str, size: int) -> Binning:
    """Bins of about equal numbers of rows, from one pass of sketches."""
    shares = [i / BINS for i in range(1, BINS)]
    x = vector_to_array(source)
    row = train.select(x.alias("x")).agg(*[F.percentile_approx(F.get("x", F.lit(i)), shares, 10_000) for i in range(size)]).first()
    return Binning([sorted(set(b or [])) for b in row])


# --- growth -------------------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of up to ``PACK_ROWS`` rows, each column as one run of bytes."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        columns = {c: [np.asarray(whole.column(c), dtype=np.int64).tobytes()] for c in ("id", "y", "fold")}
        columns["bins"] = [b"".join(whole.column("bins").to_pylist())]
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.binary()) for c, v in columns.items()})

    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, PACK_ROWS - rows)
            held, rows, batch = [*held, part], rows + part.num_rows, batch.slice(part.num_rows)
            if rows == PACK_ROWS:
                yield packed(held)
                held, rows = [], 0
    if held:
        yield packed(held)


def _unpacked(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, y, fold, bins) of each block."""
    for values in zip(*(batch.column(c) for c in ("id", "y", "fold", "bins"))):
        ids, y, fold, bins = (v.as_buffer() for v in values)
        yield *(np.frombuffer(v, dtype=np.int64) for v in (ids, y, fold)), np.frombuffer(bins, dtype=np.uint8).reshape(-1, size)


def _reach(top: np.ndarray, root: np.uint64, bins: np.ndarray) -> np.ndarray:
    """The key of the node each row has come to in the levels grown so far."""
    at = np.full(len(bins), root, dtype=np.uint64)
    if not len(top):
        return at
    while True:
        i = np.minimum(np.searchsorted(top["key"], at), len(top) - 1)
        moves = (top["key"][i] == at) & (top["feature"][i] >= 0)
        if not moves.any():
            return at
        i, rows = i[moves], np.flatnonzero(moves)
        right = bins[rows, top["feature"][i]] > top["cut"][i]
        at[rows] = np.where(right, top["right"][i], top["left"][i])


@dataclass(frozen=True)
class Plan:
    """What every task of a growth knows."""

    folds: list[int]
    trees: int
    seed: int
    size: int
    tries: int
    deepest: int | None

    def parts(self, blocks, tops: dict, wanted: dict[tuple[int, int], np.ndarray]):
        """(fold, tree, keys, nodes of rows, bins, y, w) of the rows in wanted nodes, by block and tree."""
        trees = sorted({t for _, t in wanted})
        for ids, y, fold, bins in blocks:
            for tree in trees:
                drawn = weights(self.seed, tree, ids)
                for f in self.folds:
                    keys = wanted.get((f, tree))
                    if keys is None:
                        continue
                    rows = np.flatnonzero((drawn > 0) & (fold != f))
                    i, here = self.nodes(f, tree, keys, bins[rows], tops)
                    rows, i = rows[here], i[here]
                    if len(rows):
                        yield f, tree, keys, i, bins[rows], y[rows], drawn[rows]

    def nodes(self, fold: int, tree: int, keys: np.ndarray, bins: np.ndarray, tops: dict) -> tuple[np.ndarray, np.ndarray]:
        """The place in ``keys`` of the node that each row has come to, and whether it is there."""
        at = _reach(tops.get((fold, tree), np.zeros(0, dtype=_NODE)), root_key(self.seed, tree), bins)
        i = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
        return i, keys[i] == at


def _sums(batches: Iterator[pa.RecordBatch], plan: Plan, tops: dict, wanted: dict, wide: bool) -> Iterator[pa.RecordBatch]:
    """Histograms of the wanted nodes over the blocks of a task, given out whenever ``HELD_NODES`` are held."""
    held: dict[tuple[int, int], np.ndarray] = {}

    def done() -> Iterator[pa.RecordBatch]:
        for (f, tree), counts in held.items():
            keys = wanted[f, tree]
            flat = pa.array(counts.reshape(-1), pa.float64())
            ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * (counts.size // len(keys)))
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array([f] * len(keys), pa.int32()), "tree": pa.array([tree] * len(keys), pa.int32()),
                "node": pa.array(keys.view(np.int64)), "counts": pa.ListArray.from_arrays(ends, flat),
            })

    nodes = 0
    blocks = (block for batch in batches for block in _unpacked(batch, plan.size))
    for f, tree, keys, node, bins, y, w in plan.parts(blocks, tops, wanted):
        if (f, tree) not in held:
            if nodes + len(keys) > HELD_NODES:
                yield from done()
                held, nodes = {}, 0
            drawn = min(plan.size if wide else plan.tries, plan.size)
            held[f, tree] = np.zeros((len(keys), drawn, BINS, 2))
            nodes += len(keys)
        order = feature_order(keys, plan.size)[:, : None if wide else plan.tries]
        held[f, tree] += histograms(bins, y, w, node, order)
    yield from done()


def _level(packed: DataFrame, plan: Plan, tops: dict, wanted: dict, wide: bool) -> dict:
    """{(fold, tree, key): histogram} summed over all rows, combined in each task first."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    made = packed.mapInArrow(lambda it: _sums(it, plan, tops, wanted, wide), "fold int, tree int, node long, counts array<double>")
    total = made.groupBy("fold", "tree", "node").agg(Summarizer.sum(array_to_vector("counts")).alias("counts"))
    drawn = plan.size if wide else min(plan.tries, plan.size)
    return {
        (r["fold"], r["tree"], np.int64(r["node"]).view(np.uint64)): np.rint(r["counts"].toArray()).astype(np.int64).reshape(drawn, BINS, 2)  # the sums are means times rows
        for r in total.toLocalIterator()
    }


def _grow_top(packed: DataFrame, rows: int, plan: Plan, local_rows: int) -> tuple[dict, dict]:
    """The nodes with more than ``local_rows`` rows by tree, and the roots left for tasks, with depth and rows.

    What the driver holds is a few hundred bytes for each ``local_rows`` rows of a tree.
    """
    tops: dict[tuple[int, int], np.ndarray] = {}
    small: dict[tuple[int, int], list] = {(f, t): [] for f in plan.folds for t in range(plan.trees)}
    if rows <= local_rows:
        for (_, t), keys in small.items():
            keys.append((root_key(plan.seed, t), 0, rows))
        return tops, small
    active = {(f, t): [(root_key(plan.seed, t), 0)] for f in plan.folds for t in range(plan.trees)}
    while active:
        wanted = {ft: np.sort(np.asarray([k for k, _ in nodes], dtype=np.uint64)) for ft, nodes in active.items()}
        counted = _level(packed, plan, tops, wanted, False)
        best = {}
        for key, counts in counted.items():
            order = feature_order(np.asarray([key[2]]), plan.size)[:, : plan.tries]
            best[key] = (counts, order, best_splits(counts[None], order, plan.tries))
        stuck = {}
        for (f, t, k), (counts, _, (feature, _, _)) in best.items():
            if feature[0] < 0 and counts[0].sum() > local_rows and counts[0].sum(axis=0).all():
                stuck.setdefault((f, t), []).append(k)
        if stuck:
            for key, counts in _level(packed, plan, tops, {ft: np.sort(np.asarray(k, dtype=np.uint64)) for ft, k in stuck.items()}, True).items():
                order = feature_order(np.asarray([key[2]]), plan.size)
                best[key] = (counts, order, best_splits(counts[None], order, plan.tries))
        following: dict[tuple[int, int], list] = {}
        for (f, t), nodes in active.items():
            made = []
            for k, depth in nodes:
                if (f, t, k) not in best:
                    continue
                counts, _, (feature, cut, gain) = best[f, t, k]
                n0, n1 = (int(n) for n in counts[0].sum(axis=0))
                if n0 + n1 <= local_rows:
                    small[f, t].append((k, depth, n0 + n1))
                    continue
                node = np.zeros(1, dtype=_NODE)
                node["key"], node["n0"], node["n1"], node["depth"], node["feature"] = k, n0, n1, depth, -1
                if n0 and n1 and feature[0] >= 0 and (plan.deepest is None or depth < plan.deepest):
                    sides = [child_keys(np.asarray([k]), s)[0] for s in (0, 1)]
                    node["feature"], node["cut"], node["gain"], node["left"], node["right"] = feature[0], cut[0], gain[0], *sides
                    following.setdefault((f, t), []).extend((s, depth + 1) for s in sides)
                made.append(node)
            if made:
                tops[f, t] = np.sort(np.concatenate([tops.get((f, t), np.zeros(0, dtype=_NODE)), *made]), order="key")
        active = following
    return tops, small


def _units(small: dict, local_rows: int) -> list[tuple[int, dict[int, list]]]:
    """(tree, {fold: nodes left}) of every task: nodes of one tree that hold ``local_rows`` together, or one.

    The nodes of all folds that come of the same turns in the tree go together, as they share most
    of their rows.
    """
    by_tree: dict[int, dict] = {}
    for (f, t), nodes in small.items():
        for k, depth, rows in nodes:
            by_tree.setdefault(t, {}).setdefault(int(k), []).append((f, int(k), depth, rows))
    units = []
    for t, by_key in sorted(by_tree.items()):
        unit, held = {}, 0
        for _, alike in sorted(by_key.items()):
            most = max(rows for *_, rows in alike)
            if unit and held + most > local_rows:
                units.append((t, unit))
                unit, held = {}, 0
            held += most
            for f, k, depth, _ in alike:
                unit.setdefault(f, []).append((k, depth))
        units.append((t, unit))
    return units


def _grow_unit(batches: Iterator[pa.RecordBatch], plan: Plan, tops: dict, tree: int, left: dict[int, list]) -> Iterator[pa.RecordBatch]:
    """Grows the nodes left of one tree; the rows that lie in any of them are held once."""
    keys = {f: np.sort(np.asarray([k for k, _ in nodes], dtype=np.uint64)) for f, nodes in left.items()}
    depths = {(f, k): d for f, nodes in left.items() for k, d in nodes}
    held = []
    for ids, y, fold, bins in (block for batch in batches for block in _unpacked(batch, plan.size)):
        w = weights(plan.seed, tree, ids)
        drawn = np.flatnonzero(w > 0)
        bins, fold = bins[drawn], fold[drawn]
        places = np.full((len(drawn), len(keys)), -1, dtype=np.int32)
        for at, (f, own) in enumerate(keys.items()):
            i, here = plan.nodes(f, tree, own, bins, tops)
            places[:, at] = np.where(here & (fold != f), i, -1)
        some = np.flatnonzero((places >= 0).any(axis=1))
        held.append((bins[some], y[drawn][some].astype(np.uint8), w[drawn][some].astype(np.uint8), places[some]))
    if not held:
        return
    bins, y, w, places = (np.concatenate(v) for v in zip(*held))
    held.clear()
    for at, (f, own) in enumerate(keys.items()):
        for i, k in enumerate(own):
            rows = np.flatnonzero(places[:, at] == i)
            if len(rows):
                yield _packed(f, tree, grow(bins[rows], y[rows].astype(np.int64), w[rows].astype(np.int64), k, depths[f, int(k)], plan.tries, plan.deepest))


def _packed(fold: int, tree: int, nodes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"fold": pa.array([fold], pa.int32()), "tree": pa.array([tree], pa.int32()), "nodes": pa.array([len(nodes)]), "pack": pa.array([nodes.tobytes()])})


def grow_forests(rows: DataFrame, folds: Sequence[int], trees: int, size: int, seed: int, deepest: int | None = None, local_rows: int | None = None) -> DataFrame:
    """(fold, tree, nodes, pack) of ``trees`` trees for each of ``folds``, written once.

    ``rows`` has id, y, fold and bins; a forest leaves out the rows of its own fold.
    """
    spark = rows.sparkSession
    plan = Plan(list(folds), trees, seed, size, max(1, int(np.sqrt(size))), deepest)
    local_rows = LOCAL_ROWS if local_rows is None else local_rows
    packed = settle(rows.select("id", "y", "fold", "bins").mapInArrow(_pack, "id binary, y binary, fold binary, bins binary"), "id")
    many = packed.agg(F.sum(F.length("id")) / 8).first()[0] or 0
    tops, small = _grow_top(packed, int(many), plan, local_rows)
    units = _units(small, local_rows)
    # each task streams the blocks past its own unit
    whole, made = packed.coalesce(1), []
    for tree, left in units:
        above = {(f, tree): tops[f, tree] for f in plan.folds if (f, tree) in tops}
        made.append(whole.mapInArrow(partial(_grow_unit, plan=plan, tops=above, tree=tree, left=left), _PACKS))
    rounds = [settle(_union(made[a : a + UNITS]), "tree") for a in range(0, len(made), UNITS)]
    if tops:
        rounds.append(settle(spark.createDataFrame([(f, t, len(n), n.tobytes()) for (f, t), n in tops.items()], _PACKS), "tree"))
    return _union(rounds) if rounds else spark.createDataFrame([], _PACKS)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """Of many, in halves, so that the plan stays flat."""
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _union(parts[:middle]).unionByName(_union(parts[middle:]))


# --- scoring ------------------------------------------------------------------------------


class _Tree:
    """A tree as one number per node: the place of its left child, before its right one, its feature and its cut."""

    def __init__(self, packs: list[bytes], root: np.uint64):
        nodes = np.concatenate([np.frombuffer(p, dtype=_NODE) for p in packs])
        nodes = nodes[np.argsort(nodes["depth"], kind="stable")]  # the levels that all rows pass lie together
        by_key = np.argsort(nodes["key"])
        known = nodes["key"][by_key]
        inner = np.flatnonzero(nodes["feature"] >= 0)
        left = 1 + 2 * np.arange(len(inner))
        place = np.zeros(len(nodes), dtype=np.int64)  # the root stays first
        for side, to in (("left", left), ("right", left + 1)):
            place[by_key[np.searchsorted(known, nodes[side][inner])]] = to
        self.steps = np.full(len(nodes), -1, dtype=np.int64)
        self.steps[place[inner]] = left << 32 | nodes["feature"][inner].astype(np.int64) << 16 | nodes["cut"][inner]
        self.share = np.empty(len(nodes), dtype=np.int64)
        self.share[place] = (nodes["n1"] * UNIT) // np.maximum(nodes["n0"] + nodes["n1"], 1)

    def shares(self, bins: np.ndarray, depths: Sequence[int | None]) -> np.ndarray:
        """The share of class 1 where each row ends, for each depth (None: as deep as it goes)."""
        return np.concatenate([self._shares(bins[a : a + SCORE_ROWS], depths) for a in range(0, max(1, len(bins)), SCORE_ROWS)])

    def _shares(self, bins: np.ndarray, depths: Sequence[int | None]) -> np.ndarray:
        flat, size = bins.ravel(), bins.shape[1]
        at, out, level = np.zeros(len(bins), dtype=np.int64), np.zeros((len(bins), len(depths)), dtype=np.int64), 0
        rows, here = np.arange(len(bins)), at
        while True:
            for i, d in enumerate(depths):
                if d == level:
                    out[:, i] = self.share.take(at)
            step = self.steps.take(here)
            moving = np.flatnonzero(step >= 0)
            if not len(moving):
                break
            rows, step = rows.take(moving), step.take(moving)
            right = flat.take(rows * size + (step >> 16 & 0xFFFF)) > (step & 0xFFFF)
            here = (step >> 32) + right
            at[rows] = here
            level += 1
        for i, d in enumerate(depths):
            if d is None or d > level:
                out[:, i] = self.share.take(at)
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids and bins of the rows of each batch, as one record for each fold."""
    for batch in batches:
        fold = np.asarray(batch.column("fold"), dtype=np.int64)
        for f in np.unique(fold):
            part = batch.filter(pa.array(fold == f))
            ids = part.column("id").cast(pa.int64())
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array([int(f)], pa.int32()), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                "pack": pa.array([b"".join(part.column("bins").to_pylist())], pa.binary()),
            })


def _score(batches: Iterator[pa.RecordBatch], seed: int, size: int, counts: Sequence[int], depths: Sequence[int | None]) -> Iterator[pa.RecordBatch]:
    """A sorted stream by (fold, grp): trees first, then blocks of rows; sums over the trees of the group."""
    at, packs, trees = None, {}, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("fold", "grp", "tree"))
        for place, (fold, grp, tree) in enumerate(zip(*columns)):
            if (fold, grp) != at:
                at, packs, trees = (fold, grp), {}, []
            pack = batch.column("pack")[place].as_py()
            if tree is not None:
                packs.setdefault(tree, []).append(pack)
                continue
            if packs and not trees:
                trees, packs = [(t, _Tree(p, root_key(seed, t))) for t, p in packs.items()], {}
            bins = np.frombuffer(pack, dtype=np.uint8).reshape(-1, size)
            sums = np.zeros((len(bins), len(counts), len(depths)), dtype=np.int64)
            for t, known in trees:
                found = known.shares(bins, depths)
                for i, n in enumerate(counts):
                    if t < n:
                        sums[:, i] += found
            flat = sums.reshape(len(bins), -1)
            made = {"id": batch.column("ids")[place].values, "fold": pa.array(np.full(len(bins), fold, dtype=np.int32))}
            yield pa.RecordBatch.from_pydict(made | {f"s{i}": pa.array(flat[:, i]) for i in range(flat.shape[1])})


def score_forests(packs: DataFrame, rows: DataFrame, seed: int, size: int, counts: Sequence[int], depths: Sequence[int | None]) -> DataFrame:
    """(id, fold, s0, s1, ...): sums of class-1 shares by number of trees, then depth.

    ``rows`` has id, fold and bins; a row is scored by the forest of its fold. Trees are dealt
    into groups of a bounded number of nodes, rows are copied once for each group, in blocks, and
    a task streams blocks past the trees of one group. In units of ``UNIT`` and exact.
    """
    spark = rows.sparkSession
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = max(counts)
    most = packs.groupBy("fold").agg(F.sum("nodes").alias("n")).agg(F.max("n")).first()[0] or 0
    groups = min(trees, max(pieces, -(-int(most) // GROUP_NODES)))
    none = F.lit(None)
    first = packs.where(F.col("tree") < trees).select("fold", (F.col("tree") % groups).alias("grp"), "tree", "pack", none.cast("array<bigint>").alias("ids"))
    grp = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")
    blocks = rows.select("id", "fold", "bins").mapInArrow(_blocks, "fold int, ids array<bigint>, pack binary")
    then = blocks.select("fold", grp, none.cast("int").alias("tree"), "pack", "ids")
    dealt = first.unionByName(then).repartition(pieces, "fold", "grp").sortWithinPartitions("fold", "grp", F.asc_nulls_last("tree"))
    names = [f"s{i}" for i in range(len(counts) * len(depths))]
    sums = dealt.mapInArrow(lambda it: _score(it, seed, size, counts, depths), "id long, fold int, " + ", ".join(f"{n} long" for n in names))
    return sums.groupBy("id", "fold").agg(*[F.sum(n).alias(n) for n in names])


def importances(packs: DataFrame, fold: int, trees: int, depth: int | None, size: int) -> np.ndarray:
    """Mean over trees of each feature's share of the tree's impurity decrease; sums to 1."""

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, pack in zip(batch.column("tree").to_pylist(), batch.column("pack").to_pylist()):
                nodes = np.frombuffer(pack, dtype=_NODE)
                split = nodes[(nodes["feature"] >= 0) & (nodes["depth"] < (depth or 1 << 30))]
                total = np.bincount(split["feature"], split["gain"], size)
                yield pa.RecordBatch.from_pydict({"tree": pa.array([tree] * size, pa.int32()), "feature": pa.array(np.arange(size, dtype=np.int32)), "gain": pa.array(total)})

    rows = packs.where((F.col("fold") == fold) & (F.col("tree") < trees)).mapInArrow(gains, "tree int, feature int, gain double")
    total = np.zeros((trees, size))
    for r in rows.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect():
        total[r["tree"], r["feature"]] = r["gain"]
    whole = total.sum(axis=1, keepdims=True)
    mean = np.divide(total, whole, out=np.zeros_like(total), where=whole > 0).mean(axis=0)
    return mean / mean.sum() if mean.sum() > 0 else mean

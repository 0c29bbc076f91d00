"""Linear classifiers of a whole grid at once, by Newton steps.

One pass over the rows sums loss, gradient and Hessian of every state: a cost C, and a fold
that is left out or none. So an iteration costs two passes, however many grid points and folds
there are, and its sums are a matrix per state whatever the number of rows.

The loss is C times the sum over rows, plus half the squared weights; the intercept is free.
A hinge is rounded off over a width that shrinks until the exact hinge loss of the weights is
within ``GAP`` of a lower bound, the dual value of the rounded hinge's own multipliers.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame

Lift = Callable[[np.ndarray], np.ndarray]

ALL = -1
GAP = 1e-3  # relative duality gap of a hinge fit
WIDTHS = (4.0, 1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001, 0.0003)  # at first every row is on the curve
SHARES = 0.6 ** np.arange(24)  # of a Newton step, tried in one pass
BLOCK = 16_384  # the sums of a block are large: few of them are added up
LIFT_ROWS = 64
RUN = 512  # margins whose losses are summed at once: they stay in the cache


@dataclass(frozen=True)
class States:
    """Weights, intercept last, by fold left out and cost."""

    folds: list[int]
    costs: list[float]
    weights: np.ndarray  # folds x costs x (inputs + 1)
    passes: int

    def of(self, fold: int, cost: float) -> np.ndarray:
        return self.weights[self.folds.index(fold), self.costs.index(cost)]


def logistic(z: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of a margin, and its first and second derivative."""
    p = 1.0 / (1.0 + np.exp(np.minimum(z, 700.0)))
    return np.logaddexp(0.0, -z), -p, p * (1.0 - p)


def hinge(z: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(0, 1 - z), a parabola for margins from 1 - width to 1."""
    short = 1.0 - z
    inside = (short > 0) & (short < width)
    loss = np.where(inside, short * short / (2 * width), np.where(short > 0, short - width / 2, 0.0))
    return loss, -np.clip(short / width, 0.0, 1.0), inside / width


def logistic_total(z: np.ndarray, width: float) -> np.ndarray:
    """Loss of each column of margins; factors of at most 2 are multiplied before one logarithm."""
    runs = np.arange(0, len(z), RUN)
    factors = np.multiply.reduceat(1.0 + np.exp(-np.abs(z)), runs, axis=0)
    return np.log(factors).sum(axis=0) + np.maximum(-z, 0.0).sum(axis=0)


def hinge_total(z: np.ndarray, width: float) -> np.ndarray:
    short = np.maximum(1.0 - z, 0.0)
    bent = np.minimum(short, width)
    short -= 0.5 * bent
    return np.einsum("ij,ij->j", bent, short) / width


LOSSES = {"logreg": logistic, "svm": hinge}
TOTALS = {"logreg": logistic_total, "svm": hinge_total}


def _inputs(batch: pa.RecordBatch, lift: Lift | None) -> np.ndarray:
    """The inputs of a batch, through the lift if there is one, and a one for the intercept."""
    x = np.asarray(batch.column("x").flatten(), dtype=np.float64).reshape(batch.num_rows, -1)
    if lift is None:
        return np.concatenate([x, np.ones((len(x), 1))], axis=1)
    one = np.ones((len(x), lift(x[:0]).shape[1] + 1))
    for a in range(0, len(x), LIFT_ROWS):  # few enough to stay in the cache
        one[a : a + LIFT_ROWS, :-1] = lift(x[a : a + LIFT_ROWS])
    return one


def _square(rows: np.ndarray) -> np.ndarray:
    return rows.T @ rows


def _add_bends(hess: np.ndarray, one: np.ndarray, fold: np.ndarray, bend: np.ndarray, folds: list[int], live: np.ndarray, kind: str) -> None:
    """Adds the Hessian of a block to that of each live state; ``bend`` has a column for each.

    Rows on the curve of a hinge all bend alike, and nearly the same ones in every fold. So the
    products are summed once for each cost, by fold of the rows, for the state that leaves no
    row out; the others add and take away the rows in which they differ.
    """
    costs = len(live) // len(folds)
    for c in range(costs):
        states = [(i, i * costs + c) for i in range(len(folds)) if live[i * costs + c]]
        if kind == "svm" and ALL in folds and len(states) > 1:
            on = bend[:, folds.index(ALL) * costs + c] > 0
            for g in np.unique(fold):
                shared = _square(one[on & (fold == g)])
                for i, s in states:
                    if folds[i] != g:
                        hess[s] += shared
            for i, s in states:
                kept, own = fold != folds[i], bend[:, s] > 0
                for more, sign in ((kept & own & ~on, 1.0), (kept & on & ~own, -1.0)):
                    if more.any():
                        hess[s] += sign * _square(one[more])
            continue
        for _, s in states:
            if kind == "svm":
                hess[s] += _square(one[bend[:, s] > 0])
            else:
                hess[s] += _square(one * np.sqrt(bend[:, s : s + 1]))


def _pass(batches: Iterator[pa.RecordBatch], kind: str, folds: list[int], weights: np.ndarray, width: float, lift: Lift | None, steps: np.ndarray | None, live: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each live state: loss, exact hinge, multipliers, gradient, upper half of the Hessian.

    With ``steps``, the loss at each of ``SHARES`` of the state's step instead.
    """
    size, costs = weights.shape[2] - 1, weights.shape[1]
    upper = np.triu_indices(size + 1)
    states = weights.shape[0] * costs
    sums = np.zeros((states, len(SHARES) if steps is not None else 4 + size))
    hess = np.zeros((states, size + 1, size + 1)) if steps is None else None
    flat, left_out = weights.reshape(states, -1), np.repeat(folds, costs)
    seen = False
    for whole in batches:
        for a in range(0, whole.num_rows, BLOCK):
            seen, batch = True, whole.slice(a, BLOCK)
            one, fold = _inputs(batch, lift), np.asarray(batch.column("fold"))
            sign = 2.0 * np.asarray(batch.column("y"), dtype=np.float64)[:, None] - 1.0
            out = fold[:, None] == left_out[live]
            # a row that a state leaves out has a margin without loss there
            z = np.where(out, np.inf, (one @ flat[live].T) * sign)
            if steps is not None:
                dz = np.where(out, 0.0, (one @ steps.reshape(states, -1)[live].T) * sign)
                for b in range(0, len(z), RUN):
                    from_, by = z[b : b + RUN], dz[b : b + RUN]
                    for j, t in enumerate(SHARES):
                        sums[live, j] += TOTALS[kind](from_ + t * by, width)
                continue
            _, slope, bend = LOSSES[kind](z, width)
            sums[live, 0] += TOTALS[kind](z, width)
            sums[live, 1] += np.maximum(0.0, 1.0 - z).sum(axis=0)
            sums[live, 2] -= slope.sum(axis=0)
            sums[live, 3:] += (slope * sign).T @ one
            bends = np.zeros((len(one), states))
            bends[:, live] = bend
            if kind == "svm" and ALL in folds:  # which rows bend where none is left out, settled or not
                at = slice(folds.index(ALL) * costs, (folds.index(ALL) + 1) * costs)
                bends[:, at] = LOSSES[kind]((one @ flat[at].T) * sign, width)[2]
            _add_bends(hess, one, fold, bends, folds, live, kind)
    if hess is not None:
        sums = np.concatenate([sums, hess[:, upper[0], upper[1]] / (width if kind == "svm" else 1.0)], axis=1)
    if seen:
        ends = pa.array(np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1])
        lists = pa.ListArray.from_arrays(ends, pa.array(sums.ravel(), pa.float64()))
        yield pa.RecordBatch.from_pydict({"state": pa.array(np.arange(len(sums), dtype=np.int32)), "sums": lists})


def _collect(rows: DataFrame, kind: str, folds: list[int], weights: np.ndarray, width: float, lift: Lift | None, steps: np.ndarray | None = None, live: np.ndarray | None = None) -> np.ndarray:
    """The sums of all rows, states x columns; partial sums are combined in the JVM."""
    live = np.ones(weights.shape[0] * weights.shape[1], dtype=bool) if live is None else live
    made = rows.mapInArrow(lambda it: _pass(it, kind, folds, weights, width, lift, steps, live), "state int, sums array<double>")
    found = {r["state"]: r["sums"].toArray() for r in made.groupBy("state").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()}
    size = weights.shape[2] - 1
    empty = np.zeros(len(SHARES) if steps is not None else 4 + size + (size + 1) * (size + 2) // 2)
    return np.stack([found.get(s, empty) for s in range(weights.shape[0] * weights.shape[1])])


def fit_states(rows: DataFrame, kind: str, costs: Sequence[float], folds: Sequence[int], size: int, lift: Lift | None = None, iterations: int = 1000) -> States:
    """Every state's weights. ``rows`` has x (an array), y (0 or 1) and fold.

    ``size`` is the number of inputs, after the lift if there is one. An iteration is a pass
    for the Newton steps of all states and one for the best share of each step. A state whose
    step promises nothing more, or whose gap is closed, stays as it is.
    """
    folds, costs = list(folds), [float(c) for c in costs]
    shape = (len(folds), len(costs), size + 1)
    cost = np.tile(costs, len(folds))
    upper, ridge = np.triu_indices(size + 1), np.eye(size + 1)
    ridge[-1, -1] = 0.0
    best, final, passes = np.zeros((len(cost), size + 1)), np.zeros(len(cost), dtype=bool), 0
    enough = 1e-12 if kind == "logreg" else 0.1 * GAP
    for width in WIDTHS if kind == "svm" else (0.0,):
        done = final.copy()
        while not done.all():
            if passes >= iterations:
                warnings.warn(f"{kind} stopped after {passes} passes without converging", stacklevel=2)
                return States(folds, costs, best.reshape(shape), passes)
            sums = _collect(rows, kind, folds, best.reshape(shape), width, lift, live=~done)
            square = 0.5 * (best[:, :-1] ** 2).sum(axis=1)
            value, step = square + cost * sums[:, 0], np.zeros_like(best)
            for s in np.flatnonzero(~done):
                slope = cost[s] * sums[s, 3 : 4 + size]
                if kind == "svm":
                    exact = square[s] + cost[s] * sums[s, 1]
                    lower = cost[s] * sums[s, 2] - 0.5 * slope[:-1] @ slope[:-1] - (1 + abs(best[s, -1])) * abs(slope[-1])
                    if exact - lower <= GAP * exact:
                        done[s] = final[s] = True
                        continue
                gradient = slope + ridge @ best[s]
                hess = np.zeros((size + 1, size + 1))
                hess[upper] = cost[s] * sums[s, 4 + size :]
                hess = hess + np.triu(hess, 1).T + ridge
                step[s] = -np.linalg.solve(hess + 1e-9 * np.trace(hess) / (size + 1) * np.eye(size + 1), gradient)
                if -gradient @ step[s] <= enough * abs(value[s]):
                    if kind == "logreg":  # so near the end a whole step leaves the square of what was left
                        best[s] += step[s]
                    done[s], step[s] = True, 0.0
            passes += 1
            if done.all():
                break
            losses = _collect(rows, kind, folds, best.reshape(shape), width, lift, step.reshape(shape), ~done)
            passes += 1
            for s in np.flatnonzero(~done):
                tried = best[s] + np.outer(SHARES, step[s])
                found = 0.5 * (tried[:, :-1] ** 2).sum(axis=1) + cost[s] * losses[s]
                j = int(np.argmin(found))
                if found[j] >= value[s]:
                    done[s] = True
                else:
                    best[s] = tried[j]
        if kind == "logreg" or final.all():
            break
    return States(folds, costs, best.reshape(shape), passes)


def margins(rows: DataFrame, weights: dict[int, np.ndarray], keep: Sequence[str], lift: Lift | None = None) -> DataFrame:
    """The kept columns and ``margins``: one for each row of weights that a row's fold has."""
    names = list(keep)

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, fold = _inputs(batch, lift), np.asarray(batch.column("fold"))
            out = np.zeros((len(one), len(next(iter(weights.values())))))
            for f, w in weights.items():
                out[fold == f] = one[fold == f] @ w.T
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(list(out), pa.list_(pa.float64()))], [*names, "margins"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    return rows.mapInArrow(dot, f"{schema}, margins array<double>")

"""Classifiers, their grid search, and the tables that report them."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import catalog as cat
from riskloom.operators import forest, linear
from riskloom.operators.evaluate import metrics_prf, pr_auc
from riskloom.operators.prepare import Prepared
from riskloom.session import settle

LABEL = "Target"
ALL = -1  # the fold of the final fit, which holds no row out
#: (-1)^k / (2 k + 1)!; what is left out is below 1e-18 up to a quarter turn
_SINE = [(-1.0) ** k / math.factorial(2 * k + 1) for k in range(11)]


@dataclass(frozen=True)
class FourierFeatures:
    """Random cosine features whose inner products approximate the RBF kernel.

    Rahimi and Recht, 2007. A linear machine on these features approximates the kernel one,
    better with more of them. The weights are a small constant matrix.
    """

    weights: np.ndarray
    offsets: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = x @ self.weights
        out += self.offsets
        _cosines(out)
        out *= np.sqrt(2.0 / len(self.offsets))
        return out


def _cosines(angles: np.ndarray) -> None:
    """Puts the cosine in place of each angle, off by a few units of the last digit; four times as fast as ``np.cos``.

    The sine of a quarter turn less the angle, from the nearest whole turn, by its series.
    """
    angles *= 0.5 / np.pi
    angles -= np.rint(angles)
    np.abs(angles, out=angles)
    np.subtract(0.25, angles, out=angles)
    angles *= 2.0 * np.pi
    square = angles * angles
    series = square * _SINE[-1]
    for factor in _SINE[-2:0:-1]:
        series += factor
        series *= square
    series += 1.0
    angles *= series


def fit_fourier(rows: DataFrame, size: int = 256, seed: int = 42) -> FourierFeatures:
    """Kernel width 1 / (dimensions x variance of all inputs), the usual default; rows have an array x."""
    row = rows.select(
        Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("x")).alias("s")
    ).first()["s"]
    mean, variance = row["mean"].toArray(), row["variance"].toArray()
    n = row["count"]
    overall = (variance * (n - 1) / n + mean**2).mean() - mean.mean() ** 2
    gamma = 1.0 / (len(mean) * overall) if overall > 0 else 1.0
    draw = np.random.default_rng(seed)
    return FourierFeatures(
        draw.normal(0.0, np.sqrt(2.0 * gamma), (len(mean), size)), draw.uniform(0.0, 2.0 * np.pi, size)
    )


# --- fitted models ------------------------------------------------------------------------


@dataclass(frozen=True)
class LinearModel:
    """Weights, and how a margin becomes a probability: (slope, offset) of a logistic curve."""

    weights: np.ndarray
    curve: tuple[float, float]
    lift: FourierFeatures | None = None

    def score(self, df: DataFrame, key: str) -> DataFrame:
        rows = df.select(key, LABEL, vector_to_array("pca").alias("x"), F.lit(ALL).alias("fold"))
        margin = linear.margins(rows, {ALL: self.weights[None]}, [key, LABEL], self.lift)
        m = F.col("margins")[0]
        slope, offset = self.curve
        return margin.select(key, LABEL, (m > 0).cast("int").alias("prediction"), (1.0 / (1.0 + F.exp(-(m * slope + offset)))).alias("score"))


@dataclass(frozen=True)
class ForestModel:
    """A forest's trees in the shared folder; a point of the grid says how much of them counts."""

    packs: DataFrame
    binning: forest.Binning
    size: int
    seed: int
    trees: int
    depth: int | None

    def score(self, df: DataFrame, key: str) -> DataFrame:
        rows = self.binning.transform(df.withColumns({"id": F.col(key).cast("long"), "fold": F.lit(ALL)}), ["id", "fold"], "pca")
        sums = forest.score_forests(self.packs.where(F.col("fold") == ALL), rows, self.seed, self.size, [self.trees], [self.depth])
        share = F.col("s0") / F.lit(float(self.trees * forest.UNIT))
        scored = sums.select(F.col("id").alias("__id"), share.alias("score"))
        named = df.select(key, LABEL).join(scored, F.col(key).cast("long") == F.col("__id"))
        return named.select(key, LABEL, (F.col("score") > 0.5).cast("int").alias("prediction"), "score")

    def importances(self) -> np.ndarray:
        return forest.importances(self.packs, ALL, self.trees, self.depth, self.size)


@dataclass(frozen=True)
class Fitted:
    """A chosen classifier: how it was chosen and how it scores rows."""

    name: str
    best: Mapping
    cv: list[tuple[Mapping, float]]
    model: LinearModel | ForestModel

    def predict(self, df: DataFrame, key: str = cat.KEY) -> DataFrame:
        """(model, key, label, prediction, score); score is the probability of class 1."""
        return self.model.score(df, key).select(
            F.lit(self.name).alias("model"), key, F.col(LABEL).cast("int").alias("label"), "prediction", "score",
        )


# --- search -------------------------------------------------------------------------------


def _points(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def fold_scores(rows: DataFrame, predicted: Sequence[Column]) -> list[float]:
    """The mean over folds of class 1's F1, for each of several predictions, in one pass.

    ``rows`` has y and fold. A fold without a class 1, actual or predicted, scores 0.
    """
    counts = []
    for i, p in enumerate(predicted):
        counts += [F.count_if(p & (F.col("y") == 1)).alias(f"tp{i}"), F.count_if(p != (F.col("y") == 1)).alias(f"off{i}")]
    found = rows.groupBy("fold").agg(*counts).collect()
    return [
        float(np.mean([2 * r[f"tp{i}"] / max(2 * r[f"tp{i}"] + r[f"off{i}"], 1) for r in found])) if found else 0.0
        for i in range(len(predicted))
    ]


def _platt(held: DataFrame, place: int) -> tuple[float, float]:
    """The logistic curve of margins of rows that the models giving them haven't seen.

    Margins are standardised first; where they don't vary the curve is flat, at the class share.
    """
    m = F.col("margins")[place]
    mean, sd, share = held.agg(F.avg(m), F.stddev_pop(m), F.avg("y")).first()
    if not sd or sd <= 1e-6 * abs(mean):
        share = min(max(share or 0.0, 1e-9), 1 - 1e-9)
        return 0.0, float(np.log(share / (1 - share)))
    rows = held.select(F.array((m - mean) / sd).alias("x"), "y", "fold")
    slope, offset = linear.fit_states(rows, "logreg", [1e3], [ALL], 1).of(ALL, 1e3)
    return float(slope / sd), float(offset - slope * mean / sd)


def _search_linear(kind: str, name: str, rows: DataFrame, size: int, params, points: list[dict], fold_fits: bool = True) -> Fitted:
    """All points and folds of a linear family as states of one fit for each kernel."""
    folds = list(range(params.folds)) if fold_fits else []
    cv, found = [None] * len(points), {}
    for kernel in dict.fromkeys(p.get("kernel", "linear") for p in points):
        lift = fit_fourier(rows, params.fourier_size, params.seed) if kernel == "rbf" else None
        at = [i for i, p in enumerate(points) if p.get("kernel", "linear") == kernel]
        costs = [float(points[i]["C"]) for i in at]
        states = linear.fit_states(rows, kind, costs, [*folds, ALL], len(lift.offsets) if lift else size, lift, params.linear_iterations)
        held = None
        if folds:
            held = linear.margins(rows, {f: states.weights[f] for f in folds}, ["y", "fold"], lift)
            for i, score in zip(at, fold_scores(held, [F.col("margins")[j] > 0 for j in range(len(at))])):
                cv[i] = score
        found |= {i: (states.of(ALL, c), lift, held, j) for j, (i, c) in enumerate(zip(at, costs))}
    best = int(np.argmax(cv)) if folds else 0
    weights, lift, held, place = found[best]
    curve = (1.0, 0.0) if kind == "logreg" else _platt(held, place)
    scores = [(p, s) for p, s in zip(points, cv)] if folds else []
    return Fitted(name, points[best], scores, LinearModel(weights, curve, lift))


def _search_forest(name: str, train: DataFrame, size: int, params, points: list[dict], fold_fits: bool = True) -> Fitted:
    """All points are prefixes and cuts of one forest for each fold."""
    binning = forest.fit_bins(train, "pca", size)
    keyed = train.withColumns({"id": F.col(cat.KEY).cast("long"), "y": F.col(LABEL).cast("long")})
    rows = settle(binning.transform(keyed, ["id", "y", "fold"], "pca"), "id")
    folds = list(range(params.folds)) if fold_fits else []
    counts = sorted({p["n_estimators"] for p in points})
    depths = sorted({p["max_depth"] for p in points}, key=lambda d: (d is None, d))
    packs = forest.grow_forests(rows, [*folds, ALL], max(counts), size, params.seed, depths[-1])
    cv = [0.0] * len(points)
    if folds:
        sums = forest.score_forests(packs, rows.select("id", "fold", "bins"), params.seed, size, counts, depths)
        scored = rows.select("id", "y").join(sums, "id")
        columns = [F.col(f"s{counts.index(p['n_estimators']) * len(depths) + depths.index(p['max_depth'])}") * 2 > p["n_estimators"] * forest.UNIT for p in points]
        cv = fold_scores(scored, columns)
    best = points[int(np.argmax(cv))]
    model = ForestModel(packs, binning, size, params.seed, best["n_estimators"], best["max_depth"])
    return Fitted(name, best, list(zip(points, cv)) if folds else [], model)


GRIDS = {"LogisticRegression": cat.GRID_LOGREG, "RandomForest": cat.GRID_FOREST, "SVM": cat.GRID_SVM}


def _run(name: str, train: DataFrame, params, points: list[dict], fold_fits: bool) -> Fitted:
    rows = settle(train.select(cat.KEY, LABEL, "fold", "pca"), cat.KEY)
    first = rows.select(F.size(vector_to_array("pca")).alias("n")).first()
    size = first["n"] if first else 0
    if name == "RandomForest":
        return _search_forest(name, rows, size, params, points, fold_fits)
    flat = rows.select(vector_to_array("pca").alias("x"), F.col(LABEL).cast("double").alias("y"), F.col("fold").cast("int").alias("fold"))
    return _search_linear("logreg" if name == "LogisticRegression" else "svm", name, flat, size, params, points, fold_fits or name == "SVM")


def fit(name: str, train: DataFrame, params, **point) -> Fitted:
    """One classifier at one grid point. An SVM's folds are fitted too, for its probabilities."""
    return replace(_run(name, train, params, [point], False), cv=[])


def search(name: str, train: DataFrame, params, grid: Mapping | None = None) -> Fitted:
    """The best of a family's grid by cross-validated F1 of class 1, with its fit on all rows.

    Grid points and folds share the passes over the rows: see ``linear`` and ``forest``.
    """
    return _run(name, train, params, _points(GRIDS[name] if grid is None else grid), True)


def best_of(fits: Sequence[Fitted]) -> Fitted:
    """The fit with the highest cross-validated score, with the grid points of all of them."""
    winner = max(fits, key=lambda f: max(s for _, s in f.cv))
    return replace(winner, cv=[point for f in fits for point in f.cv])


def select_models(prepared: Prepared, params, names: Sequence[str] = tuple(GRIDS)) -> list[Fitted]:
    """Search every named family on the prepared training rows."""
    train = prepared.train.select(cat.KEY, LABEL, "fold", "pca")
    return [search(name, train, params) for name in names]


def predictions(fits: Sequence[Fitted], test: DataFrame) -> DataFrame:
    scored = [f.predict(test) for f in fits]
    whole = scored[0]
    for part in scored[1:]:
        whole = whole.unionByName(part)
    return whole


def cv_scores(spark, fits: Sequence[Fitted]) -> DataFrame:
    """(model, params, mean_f1), one row per grid point."""
    return spark.createDataFrame(
        [(f.name, json.dumps(dict(p)), s) for f in fits for p, s in f.cv],
        "model string, params string, mean_f1 double",
    )


def model_summary(fits: Sequence[Fitted], scored: DataFrame) -> DataFrame:
    """(model, best_params, f1, precision, recall, pr_auc), one row per model."""
    best = scored.sparkSession.createDataFrame(
        [(f.name, json.dumps(dict(f.best))) for f in fits], "model string, best_params string"
    )
    measured = metrics_prf(scored, ["model"]).join(pr_auc(scored, ["model"]), "model")
    return best.join(measured, "model").select(
        "model", "best_params", "f1", "precision", "recall", "pr_auc"
    )


def forest_importances(fit: Fitted, spark) -> DataFrame:
    """(component, importance) of a forest, strongest first."""
    values = fit.model.importances()
    rows = [(f"PC{i + 1}", float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "component string, importance double").orderBy(
        F.col("importance").desc(), "component"
    )

"""Forests and linear machines whose grid points and folds share the passes over the rows."""

import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import catalog as cat
from riskloom.operators import forest, linear, models, prepare
from riskloom.params import Params

warnings.filterwarnings("error", message=".*without converging")


@pytest.fixture(scope="module")
def train(raw):
    return prepare.prepare(raw, Params()).train.select(cat.KEY, "Target", "fold", "pca")


@pytest.fixture(scope="module")
def binned(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.7 * rng.normal(size=900) > 0).astype(int)
    bins = np.clip((x * 5 + 16).astype(int), 0, 31).astype(np.uint8)
    bins[:, 4] = 7  # a feature that never varies
    bins[:200] = bins[200:400]  # rows that no split can part
    rows = [(i, int(y[i]), i % 3, bytearray(bins[i].tobytes())) for i in range(900)]
    return spark.createDataFrame(rows, "id long, y long, fold int, bins binary").repartition(4), bins, y


def nodes_of(packs):
    """{(fold, tree): {key: node}}"""
    out = {}
    for r in packs.collect():
        out.setdefault((r["fold"], r["tree"]), {}).update({int(n["key"]): n for n in np.frombuffer(r["pack"], dtype=forest._NODE)})
    return out


def test_growing_by_levels_over_tasks_gives_the_same_trees(binned):
    rows, *_ = binned
    whole = nodes_of(forest.grow_forests(rows, [-1, 0], 4, 5, seed=1))
    parted = nodes_of(forest.grow_forests(rows, [-1, 0], 4, 5, seed=1, local_rows=60))
    assert whole.keys() == parted.keys() and all(whole[t] == parted[t] for t in whole)


def test_rows_are_not_dealt_out_for_every_tree(binned, monkeypatch):
    rows, *_ = binned
    plans = []
    settle = forest.settle
    monkeypatch.setattr(forest, "settle", lambda df, key: plans.append((df._jdf.queryExecution().executedPlan().toString(), df.rdd.getNumPartitions())) or settle(df, key))
    monkeypatch.setattr(forest, "UNITS", 3)
    packs = forest.grow_forests(rows, [-1, 0, 1], 4, 5, seed=1, local_rows=300)
    assert packs.select("fold", "tree").distinct().count() == 12
    assert not any("Exchange" in p for p, _ in plans[1:])
    assert 3 in [n for _, n in plans[1:]]  # tasks of one round


def test_tasks_take_nodes_up_to_their_rows():
    small = {(f, t): [(np.uint64(k), 2, 40 + f) for k in (3, 5, 9)] for f in (-1, 0) for t in (0, 1)}
    units = forest._units(small, 85)
    assert [(t, {f: [k for k, _ in nodes] for f, nodes in left.items()}) for t, left in units] == [
        (t, {-1: keys, 0: keys}) for t in (0, 1) for keys in ([3, 5], [9])
    ]


def test_a_cut_is_the_forest_grown_to_that_depth(binned):
    rows, *_ = binned
    full = forest.grow_forests(rows, [-1, 1], 6, 5, seed=2)
    score = rows.select("id", F.when(F.col("id") % 2 == 0, -1).otherwise(1).alias("fold"), "bins")
    cut = {r["id"]: r for r in forest.score_forests(full, score, 2, 5, [3, 6], [0, 2, 4, None]).collect()}
    for i, depth in enumerate((0, 2, 4, None)):
        for j, trees in enumerate((3, 6)):
            grown = forest.grow_forests(rows, [-1, 1], trees, 5, seed=2, deepest=depth)
            alone = {r["id"]: r["s0"] for r in forest.score_forests(grown, score, 2, 5, [trees], [None]).collect()}
            assert alone == {k: r[f"s{4 * j + i}"] for k, r in cut.items()}


def test_trees_are_those_of_a_row_by_row_version(binned):
    rows, bins, y = binned
    made = nodes_of(forest.grow_forests(rows, [0], 3, 5, seed=9))
    kept = np.flatnonzero(np.arange(900) % 3 != 0)

    def check(tree, key, rows_, w):
        node = made[0, tree][int(key)]
        n1, n = int((w * y[rows_]).sum()), int(w.sum())
        assert (node["n0"], node["n1"]) == (n - n1, n1)
        order = forest.feature_order(np.asarray([key]), 5)[0]

        def gain(f, c):
            left = bins[rows_, f] <= c
            parts = [(w[s] @ y[rows_[s]], w[s].sum()) for s in (left, ~left)]
            if not all(m for _, m in parts):
                return None
            return sum((a * a + (m - a) ** 2) / m for a, m in parts) - (n1 * n1 + (n - n1) ** 2) / n

        options = []
        for place, f in enumerate(order):
            here = [(g, -place, -c) for c in range(31) if (g := gain(f, c)) is not None]
            options += here
            if place + 1 >= 2 and options:
                break
        if n1 in (0, n) or not options:
            assert node["feature"] == -1
            return 1
        top = max(options)
        assert (node["feature"], node["cut"]) == (order[-top[1]], -top[2]) and np.isclose(node["gain"], top[0])
        left = bins[rows_, node["feature"]] <= node["cut"]
        return 1 + check(tree, node["left"], rows_[left], w[left]) + check(tree, node["right"], rows_[~left], w[~left])

    for tree in range(3):
        w = forest.weights(9, tree, kept)
        assert check(tree, forest.root_key(9, tree), kept[w > 0], w[w > 0]) == len(made[0, tree])


def test_weights_are_poisson():
    w = forest.weights(5, 17, np.arange(200_000))
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02


def test_forest_search(spark, train):
    fitted = models.search("RandomForest", train, Params())
    assert len(fitted.cv) == 6 and fitted.best == max(fitted.cv, key=lambda c: c[1])[0]
    total = models.forest_importances(fitted, spark)
    assert abs(total.agg(F.sum("importance")).first()[0] - 1) < 1e-9 and total.count() == fitted.model.size
    scored = fitted.predict(train)
    assert scored.count() == train.count() and scored.where("score between 0 and 1").count() == train.count()
    assert scored.where("prediction <> int(score > 0.5)").count() == 0


def flat(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=n) > 0.3).astype(float)
    fold = np.arange(n) % 3
    rows = [(x[i].tolist(), float(y[i]), int(fold[i])) for i in range(n)]
    return spark.createDataFrame(rows, "x array<double>, y double, fold int").repartition(3), x, y, fold


def test_logistic_states_are_the_minima(spark):
    rows, x, y, fold = flat(spark, 400, 1)
    states = linear.fit_states(rows, "logreg", [0.01, 1.0, 10.0], [0, 1, 2, -1], 3)
    one = np.c_[x, np.ones(400)]
    for f in (0, 1, 2, -1):
        keep = fold != f
        for c in (0.01, 1.0, 10.0):
            w = np.zeros(4)
            for _ in range(50):
                p = 1 / (1 + np.exp(-one[keep] @ w))
                g = c * one[keep].T @ (p - y[keep]) + w * [1, 1, 1, 0]
                w = w - np.linalg.solve(c * (one[keep].T * (p * (1 - p))) @ one[keep] + np.diag([1, 1, 1, 0]), g)
            assert np.allclose(states.of(f, c), w, atol=1e-6)


def test_hinge_states_close_the_gap_to_a_dual_by_hand(spark):
    rows, x, y, fold = flat(spark, 300, 2)
    costs = [0.1, 1.0, 10.0]
    states = linear.fit_states(rows, "svm", costs, [0, -1], 3)
    sign = 2 * y - 1
    for f in (0, -1):
        keep = np.flatnonzero(fold != f)
        xs, ys = x[keep], sign[keep]
        for c in costs:
            w = states.of(f, c)
            primal = 0.5 * w[:3] @ w[:3] + c * np.maximum(0, 1 - ys * (xs @ w[:3] + w[3])).sum()
            a = np.zeros(len(keep))  # pairs of multipliers, the most violating one each time
            for _ in range(60_000):
                g = ys - xs @ (xs.T @ (a * ys))  # y times the dual's gradient
                up, low = (a < c) & (ys > 0) | (a > 0) & (ys < 0), (a < c) & (ys < 0) | (a > 0) & (ys > 0)
                i, j = np.where(up, g, -np.inf).argmax(), np.where(low, g, np.inf).argmin()
                if g[i] - g[j] < 1e-6:
                    break
                room_i, room_j = (c - a[i] if ys[i] > 0 else a[i]), (a[j] if ys[j] > 0 else c - a[j])
                t = min(room_i, room_j, (g[i] - g[j]) / max(((xs[i] - xs[j]) ** 2).sum(), 1e-12))
                a[i], a[j] = a[i] + ys[i] * t, a[j] - ys[j] * t
            v = xs.T @ (a * ys)
            dual = a.sum() - 0.5 * v @ v
            assert dual - 1e-6 <= primal <= dual * (1 + 2 * linear.GAP) + 1e-6


def test_cosine_features_cost_less_than_cosines():
    import time

    import pyarrow as pa

    draw = np.random.default_rng(8)
    x = draw.normal(size=(4_096, 32))
    lift = models.FourierFeatures(draw.normal(size=(32, 256)), draw.uniform(0, 6, 256))
    batch = pa.RecordBatch.from_pydict({"x": pa.array(list(x), pa.list_(pa.float64()))})

    def plain():
        return np.sqrt(2.0 / 256) * np.cos(x @ lift.weights + lift.offsets)

    def seconds(f):
        took = []
        for _ in range(7):
            start = time.perf_counter()
            f()
            took.append(time.perf_counter() - start)
        return min(took)

    one = linear._inputs(batch, lift)
    assert one.shape == (4_096, 257) and (one[:, -1] == 1).all() and np.abs(one[:, :-1] - plain()).max() < 1e-14
    assert seconds(lambda: linear._inputs(batch, lift)) < seconds(plain)


def test_passes_do_not_grow_with_points_and_folds(spark):
    rows, *_ = flat(spark, 300, 4)
    one = linear.fit_states(rows, "logreg", [10.0], [-1], 3).passes
    many = linear.fit_states(rows, "logreg", [0.01, 0.1, 1.0, 10.0], [0, 1, 2, -1], 3).passes
    assert many <= one + 4


def test_margins_use_the_row_s_own_fold(spark):
    rows, x, y, fold = flat(spark, 60, 5)
    weights = {f: np.arange(8.0).reshape(2, 4) * (f + 1) for f in range(3)}
    for r in linear.margins(rows, weights, ["y", "fold"]).select("margins", "fold").distinct().collect():
        assert any(np.allclose(r["margins"], np.r_[v, 1.0] @ weights[r["fold"]].T) for v in x[fold == r["fold"]])


def test_flat_margins_give_the_class_share(spark):
    held = spark.createDataFrame([([1.0], float(i % 4 > 0), i % 2) for i in range(80)], "margins array<double>, y double, fold int")
    slope, offset = models._platt(held, 0)
    assert slope == 0 and np.isclose(1 / (1 + np.exp(-offset)), 0.75)


def test_fitted_measures_agree_with_the_predictions(spark, monkeypatch):
    from conftest import SMALL

    from riskloom.plans import queries

    monkeypatch.setattr(models, "GRIDS", {"LogisticRegression": {"C": (0.1, 1.0)}, "RandomForest": {"n_estimators": (5,), "max_depth": (4,)}})
    monkeypatch.setattr(queries, "_cache", {})
    said = {}
    for r in queries.predict(spark, SMALL).collect():
        said.setdefault(r["model"], []).append((r["label"], r["prediction"]))
    cells = {(r["model"], r["actual"], r["predicted"]): r["n"] for r in queries.confusion_matrix_fitted(spark, SMALL).collect()}
    assert cells == {(m, a, p): rows.count((a, p)) for m, rows in said.items() for a in (0, 1) for p in (0, 1)}
    curve = queries.pr_curve_fitted(spark, SMALL)
    assert curve.where("threshold is null").count() == len(said) == 2
    assert queries.grid_search_cv(spark, SMALL).count() == 3


def test_splits_of_rows_are_those_of_histograms():
    draw = np.random.default_rng(5)
    bins, y, w = draw.integers(0, forest.BINS, (400, 6)).astype(np.uint8), draw.integers(0, 2, 400), draw.integers(1, 4, 400)
    bins[:200, :3] = 7  # constant in some nodes
    node = np.concatenate([np.repeat([0, 1], 100), draw.integers(2, 90, 200)])
    node = np.unique(node, return_inverse=True)[1]
    order = forest.feature_order(forest.child_keys(np.arange(1, node.max() + 2, dtype=np.uint64), 0), 6)
    for drawn in (order[:, :2], order):
        got, want = forest.row_splits(bins, y, w, node, drawn, 2), forest.best_splits(forest.histograms(bins, y, w, node, drawn), drawn, 2)
        split = want[0] >= 0
        assert (got[0] == want[0]).all() and (got[2] == want[2]).all() and (got[1] == want[1])[split].all() and split.any()


def test_rows_are_scored_in_blocks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        draw = np.random.default_rng(6)
        data = [(i, int(draw.integers(0, 2)), i % 2, bytes(draw.integers(0, 8, 3).astype(np.uint8))) for i in range(300)]
        rows = spark.createDataFrame(data, "id long, y long, fold int, bins binary").persist()
        packs = forest.grow_forests(rows, [0, 1], 3, 3, 1)
        got = {r["id"]: r for r in forest.score_forests(packs, rows, 1, 3, [1, 3], [None]).collect()}
        blocks = rows.mapInArrow(forest._blocks, "fold int, ids array<bigint>, pack binary")
        assert blocks.count() <= 2 * (300 // 50 + 8) and sorted(i for r in blocks.collect() for i in r["ids"]) == list(range(300))
        trees = {(r["fold"], r["tree"]): forest._Tree([bytes(r["pack"])], forest.root_key(1, r["tree"])) for r in packs.collect()}
        for i, _, f, b in data:
            shares = [int(trees[f, t].shares(np.frombuffer(b, dtype=np.uint8)[None], [None])[0, 0]) for t in range(3)]
            assert (got[i]["s0"], got[i]["s1"], got[i]["fold"]) == (shares[0], sum(shares), f)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("kind", ["logreg", "svm"])
def test_one_pass_sums_every_state(kind):
    import pyarrow as pa

    draw = np.random.default_rng(7)
    x, y, fold = draw.normal(size=(1300, 4)), draw.integers(0, 2, 1300), draw.integers(0, 3, 1300)
    batch = pa.RecordBatch.from_pydict({"x": pa.array(list(x)), "y": pa.array(y.astype(float)), "fold": pa.array(fold.astype(np.int32))})
    folds, width = [0, 1, 2, -1], 0.5
    weights, steps = draw.normal(size=(4, 2, 5)), draw.normal(size=(4, 2, 5))
    upper, one = np.triu_indices(5), np.concatenate([x, np.ones((1300, 1))], axis=1)
    calls = []
    square = linear._square
    linear._square = lambda rows: calls.append(len(rows)) or square(rows)
    try:
        live = np.ones(8, dtype=bool)
        sums = np.array(list(linear._pass(iter([batch]), kind, folds, weights, width, None, None, live))[0].column("sums").to_pylist())
        tried = np.array(list(linear._pass(iter([batch]), kind, folds, weights, width, None, steps, live))[0].column("sums").to_pylist())
        same = np.repeat(weights[:1], 4, axis=0)
        calls.clear()
        list(linear._pass(iter([batch]), kind, folds, same, width, None, None, live))
    finally:
        linear._square = square
    if kind == "svm":  # states that agree on their rows share the products of each cost
        assert sum(calls) <= 2 * 1300
    for i, f in enumerate(folds):
        rows, sign = one[fold != f], 2.0 * y[fold != f] - 1.0
        for c in range(2):
            z, dz = rows @ weights[i, c] * sign, rows @ steps[i, c] * sign
            loss, slope, bend = linear.LOSSES[kind](z, width)
            want = [loss.sum(), np.maximum(0, 1 - z).sum(), -slope.sum(), *(rows.T @ (slope * sign)), *((rows * bend[:, None]).T @ rows)[upper]]
            assert np.allclose(sums[2 * i + c], want, rtol=1e-10, atol=1e-9)
            assert np.allclose(tried[2 * i + c], [linear.LOSSES[kind](z + t * dz, width)[0].sum() for t in linear.SHARES], rtol=1e-10)

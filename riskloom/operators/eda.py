"""Descriptive statistics, balance, cross tables, correlation, box, density and Q-Q data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom import catalog as cat
from riskloom.functions import codes
from riskloom.functions.codes import q
from riskloom.functions.normal import inverse_normal
from riskloom.operators.features import feature_view, numeric_columns
from riskloom.operators.moments import correlations
from riskloom.operators.ordering import running_sums, value_counts, with_bucket
from riskloom.operators.quantiles import long_form, numeric_summary

STUDIED = (cat.AMOUNT, cat.DURATION, cat.AGE)


# --- descriptive statistics and balance -----------------------------------------------


def describe_numeric(df: DataFrame, columns: Sequence[str], binary: Sequence[str] = cat.FLAGS) -> DataFrame:
    """One row per numeric column: count, mean, std, min, three quartiles, max.

    ``binary`` columns hold 0, 1 or NULL, so their whole row follows from a count and a sum.
    """
    flags = [c for c in columns if c in binary]
    others = [c for c in columns if c not in binary]
    parts = []
    if others:
        parts.append(
            numeric_summary(df, others).select(
                "feature", F.col("n").alias("count"), "mean", "std", F.col("low").alias("min"),
                F.col("quantiles")[0].alias("q25"), F.col("quantiles")[1].alias("q50"),
                F.col("quantiles")[2].alias("q75"), F.col("high").alias("max"),
            )
        )
    if flags:
        # two sums per flag in one row per task; only the one row of results is unfolded
        tallies = df.agg(
            *[f(q(c)).alias(f"{name}{i}") for i, c in enumerate(flags) for name, f in (("n", F.count), ("ones", F.sum))]
        )
        rows = F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"ones{i}").cast("double").alias("ones"))
            for i, c in enumerate(flags)
        ])
        sums = tallies.select(F.inline(rows)).where("n > 0")
        n, ones = F.col("n"), F.col("ones")
        zeros = n - ones

        def quantile(p: float) -> Column:
            at = (n - 1) * F.lit(p)
            low = (F.floor(at) >= zeros).cast("double")
            high = (F.ceil(at) >= zeros).cast("double")
            return low + (high - low) * (at - F.floor(at))

        parts.append(
            sums.select(
                "feature", n.alias("count"), (ones / n).alias("mean"),
                F.when(n > 1, F.sqrt(ones * zeros / n / (n - 1))).alias("std"),
                (zeros == 0).cast("double").alias("min"),
                quantile(0.25).alias("q25"), quantile(0.5).alias("q50"), quantile(0.75).alias("q75"),
                (ones > 0).cast("double").alias("max"),
            )
        )
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # a column without any value still has its row, with count 0
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(found, "feature", "left").na.fill(0, ["count"])


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Fractional columns rounded for display."""
    fractions = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(*[F.round(q(c), digits).alias(c) if c in fractions else q(c) for c in df.columns])


def class_balance(df: DataFrame, label: str = cat.LABEL, by: Sequence[str] = ()) -> DataFrame:
    """Rows and share of each label, overall or within ``by``."""
    counts = df.where(q(label).isNotNull()).groupBy(*by, label).agg(F.count("*").alias("n"))
    # one row per label: the window sees the counted table only
    total = F.sum("n").over(Window.partitionBy(*[F.col(b) for b in by] or [F.lit(1)]))
    return counts.select(*by, label, "n", (F.lit(100.0) * F.col("n") / total).alias("percent"))


# --- categories by risk ---------------------------------------------------------------


def category_counts(df: DataFrame, features: Sequence[str] = tuple(cat.VALUE_NAMES)) -> DataFrame:
    """(feature, category, risk, n) after renaming values; unnamed ones are left out.

    All features are counted in one pass; at most a few dozen rows per task shuffle.
    """
    named = df.select(
        codes.risk_name(),
        *[codes.lookup(q(f), cat.VALUE_NAMES[f]).alias(f) for f in features],
    )
    return (
        named.unpivot(["risk"], [q(f) for f in features], "feature", "category")
        .where(F.col("category").isNotNull() & F.col("risk").isNotNull())
        .groupBy("feature", "category", "risk")
        .agg(F.count("*").alias("n"))
    )


def category_percent(df: DataFrame, features: Sequence[str] = tuple(cat.VALUE_NAMES)) -> DataFrame:
    """(feature, category, Good, Bad): each category's risks in percent, in category order."""
    good, bad = cat.RISK_NAMES.values()
    counts = category_counts(df, features)
    wide = counts.groupBy("feature", "category").agg(
        *[F.coalesce(F.sum(F.when(F.col("risk") == r, F.col("n"))), F.lit(0)).alias(r) for r in (good, bad)]
    )
    total = F.col(good) + F.col(bad)
    return wide.select(
        "feature", "category",
        *[(F.lit(100.0) * F.col(r) / total).alias(r) for r in (good, bad)],
    ).orderBy("feature", "category")


# --- correlation ----------------------------------------------------------------------


def group_name(name: Column) -> Column:
    """The chart group of a column name: the first listed prefix it starts with."""
    found = F.lit(None)
    for group, prefix in reversed(cat.GROUP_PREFIXES.items()):
        found = F.when(name.startswith(prefix), group).otherwise(found)
    return F.coalesce(found, F.lit(cat.OTHER_GROUP))


def group_place(group: Column) -> Column:
    order = F.array(*[F.lit(g) for g in (*cat.GROUP_PREFIXES, cat.OTHER_GROUP)])
    return F.array_position(order, group)


def correlation_inputs(raw: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Target and the correlated numeric columns, with their display names."""
    view = feature_view(raw, keep=()).withColumn("Target", codes.target())
    names = cat.display_names()
    shown = {
        c: names.get(c, c)
        for c in numeric_columns(view)
        if c not in ("Target", cat.LABEL) and names.get(c, c) not in cat.NOT_CORRELATED
    }
    return view.select("Target", *[q(c) for c in shown]), shown


def corr_to_target(df: DataFrame, names: dict[str, str], target: str = "Target") -> DataFrame:
    """(feature, r, strength) of every column with the target."""
    columns = [target, *names]
    label = F.array(*[F.lit(names.get(c, c)) for c in columns])
    return correlations(df, columns, against=target).select(
        label[F.col("j")].alias("feature"), "r", F.abs("r").alias("strength")
    )


def strongest(corr: DataFrame, k: int) -> DataFrame:
    """The k strongest, missing ones last; ties, up to rounding noise, by name."""
    return corr.orderBy(F.round("strength", 9).desc_nulls_last(), "feature").limit(k)


def in_group_order(corr: DataFrame) -> DataFrame:
    """Add each feature's group and its place in chart order: by group, then by name."""
    grouped = corr.withColumn("group", group_name(F.col("feature")))
    # one row per column name: small whatever the table's length
    place = F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy(group_place(F.col("group")), "feature")
    )
    return grouped.withColumn("place", place)


def corr_matrix(df: DataFrame, names: dict[str, str], k: int) -> DataFrame:
    """(x, y, r, x_place, y_place) over the k columns most correlated with the target.

    One pass finds every pair's r; what is collected are columns squared numbers.
    """
    columns = ["Target", *names]
    found = correlations(df, columns)
    every = df.sparkSession.createDataFrame(found.collect(), found.schema)
    to_target = every.where("i = 0").select(
        F.array(*[F.lit(names.get(c, c)) for c in columns])[F.col("j")].alias("feature"), "r", F.abs("r").alias("strength")
    )
    top = in_group_order(strongest(to_target, k)).orderBy("place").collect()
    at = {label: i for i, label in enumerate(names.values(), 1)}
    chosen = [at[row["feature"]] for row in top]
    labels = F.array(*[F.lit(row["feature"]) for row in top])
    place = F.array(*[F.lit(chosen.index(i) if i in chosen else None).cast("int") for i in range(len(columns))])
    pairs = every.select(place[F.col("i")].alias("i"), place[F.col("j")].alias("j"), "r").where("i is not null and j is not null")
    grid = pairs.unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), "r"))
    # the diagonal is 1 where the column varies, which any of its pairs shows
    diagonal = grid.groupBy("i").agg(F.max(F.when(F.col("r").isNotNull(), 1.0)).alias("r"))
    whole = grid.unionByName(diagonal.select("i", F.col("i").alias("j"), "r")) if len(chosen) > 1 else grid
    return whole.select(
        labels[F.col("i")].alias("x"), labels[F.col("j")].alias("y"), "r",
        (F.col("i") + 1).alias("x_place"), (F.col("j") + 1).alias("y_place"),
    )


# --- box, density and Q-Q data --------------------------------------------------------


def by_risk(df: DataFrame, features: Sequence[str] = STUDIED) -> DataFrame:
    """The features of rows with a known risk."""
    return df.select(codes.risk_name(), *[q(f) for f in features]).where(F.col("risk").isNotNull())


def _fences(df: DataFrame, features: Sequence[str]) -> DataFrame:
    summary = numeric_summary(by_risk(df, features), features, by=["risk"])
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[2]
    reach = F.lit(1.5) * (q3 - q1)
    return summary.select(
        "feature", "risk", "n", q1.alias("q1"), F.col("quantiles")[1].alias("median"), q3.alias("q3"),
        (q1 - reach).alias("fence_low"), (q3 + reach).alias("fence_high"),
    )


def box_stats(df: DataFrame, features: Sequence[str] = STUDIED) -> DataFrame:
    """Per feature and risk: quartiles, whisker ends and the number of rows beyond them."""
    fences = _fences(df, features)
    value = F.col("value")
    within = value.between(F.col("fence_low"), F.col("fence_high"))
    # two rows per feature are broadcast
    rows = long_form(by_risk(df, features), features, ["risk"]).join(
        F.broadcast(fences), ["feature", "risk"]
    )
    return rows.groupBy("feature", "risk", "n", "q1", "median", "q3").agg(
        F.min(F.when(within, value)).alias("whisker_low"),
        F.max(F.when(within, value)).alias("whisker_high"),
        F.sum((~within).cast("bigint")).alias("outliers"),
    )


def box_outliers(df: DataFrame, features: Sequence[str] = STUDIED, key: str = cat.KEY) -> DataFrame:
    """The rows beyond the whiskers, as (feature, risk, key, value)."""
    fences = _fences(df, features).select("feature", "risk", "fence_low", "fence_high")
    keyed = df.select(q(key), codes.risk_name(), *[q(f) for f in features])
    rows = long_form(keyed.where(F.col("risk").isNotNull()), features, [key, "risk"])
    beyond = (F.col("value") < F.col("fence_low")) | (F.col("value") > F.col("fence_high"))
    return (
        rows.join(F.broadcast(fences), ["feature", "risk"])
        .where(beyond)
        .select("feature", "risk", key, "value")
    )


DENSITY_TERMS = 20  # of the Taylor series within a cell
DENSITY_REACH = 39.0  # bandwidths beyond which exp(-z * z / 2) is zero in double precision


def kde_by_class(
    df: DataFrame, features: Sequence[str] = STUDIED, points: int = 200, cut: float = 3.0
) -> DataFrame:
    """(feature, risk, point, x, density): Gaussian density of each class on its own grid.

    Bandwidth is n^(-1/5) times the sample deviation, and the grid runs ``cut`` bandwidths
    past the data. The data are cut into cells one bandwidth wide, and each cell keeps the
    moments of its values about its middle: ``exp(-(u - t)^2 / 2)`` is ``exp(-u^2 / 2)`` times
    the sum of ``He_k(u) t^k / k!``. With 20 terms and ``|t| <= 1/2`` the rest is below 1e-15
    for each value (Cramer's bound: ``|He_k(u)| exp(-u^2 / 4) <= 1.09 sqrt(k!)``). Rows are
    added up in their tasks, so what moves and what meets the grid are cells, not values.

    Nulls are left out. A class of one value, or of equal values, has no bandwidth and no rows.
    """
    rows = long_form(by_risk(df, features), features, ["risk"])
    stats = (
        rows.groupBy("feature", "risk")
        .agg(
            F.count("*").alias("size"), F.stddev_samp("value").alias("sd"),
            F.min("value").alias("low"), F.max("value").alias("high"),
        )
        .withColumn("h", F.col("sd") * F.pow(F.col("size").cast("double"), F.lit(-0.2)))
        .where("h > 0")
    )
    start = F.col("low") - F.lit(cut) * F.col("h")
    step = (F.col("high") - F.col("low") + F.lit(2 * cut) * F.col("h")) / F.lit(points - 1.0)
    # two rows per feature are broadcast
    grid = F.broadcast(stats.select("feature", "risk", "size", "h", "low", start.alias("start"), step.alias("step")))

    away = (F.col("value") - F.col("low")) / F.col("h")
    t = F.col("away") - F.col("cell") - F.lit(0.5)
    moments = [F.sum(F.pow(t, F.lit(float(k)))) / F.lit(float(math.factorial(k))) for k in range(DENSITY_TERMS)]
    cells = (
        rows.join(grid, ["feature", "risk"])
        .select("feature", "risk", away.alias("away"), F.floor(away).alias("cell"))
        .groupBy("feature", "risk", "cell").agg(F.array(*moments).alias("moments"))
    )
    x = F.col("start") + F.col("point") * F.col("step")
    u = (F.col("x") - F.col("low")) / F.col("h") - F.col("cell") - F.lit(0.5)
    met = (
        cells.join(grid, ["feature", "risk"])
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x).withColumn("u", u)
    )
    # sums He_k(u) times the k-th moment, with He_(k+1) = u He_k - k He_(k-1)
    series = F.aggregate(
        "moments",
        F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("before"), F.lit(1.0).alias("now"), F.lit(0.0).alias("k")),
        lambda s, m: F.struct(
            (s["total"] + m * s["now"]).alias("total"), s["now"].alias("before"),
            (F.col("u") * s["now"] - s["k"] * s["before"]).alias("now"), (s["k"] + 1.0).alias("k"),
        ),
        lambda s: s["total"],
    )
    near = F.abs("u") <= DENSITY_REACH
    mass = F.sum(F.when(near, F.exp(F.lit(-0.5) * F.col("u") * F.col("u")) * series).otherwise(0.0))
    scale = F.col("size") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    return (
        met.groupBy("feature", "risk", "point", "x", "size", "h")
        .agg(mass.alias("mass"))
        # what is left of a series far from all values may be a negative zero
        .select("feature", "risk", "point", "x", F.greatest(F.col("mass") / scale, F.lit(0.0)).alias("density"))
    )


QQ_CHUNK = 1_000_000


def qq_points(df: DataFrame, features: Sequence[str] = STUDIED) -> DataFrame:
    """(feature, place, theoretical, ordered): normal quantile against each ordered value.

    Places come from running sums over distinct values. A value shared by many rows is
    split into runs of places before the runs unfold, so no task unfolds all of them.
    """
    whole = all(isinstance(df.schema[f].dataType, T.IntegralType) for f in features)
    rows = df.select(*[q(f).cast("bigint" if whole else "double").alias(f) for f in features]).unpivot(
        [], [q(f) for f in features], "feature", "value"
    ).where(F.col("value").isNotNull())
    counted = with_bucket(value_counts(rows, ["feature"], "value"), "value")
    placed = running_sums(counted, ["feature"], "bucket", "value", {"upto": "n"})
    sizes = counted.groupBy("feature").agg(F.sum("n").alias("size"))
    runs = (
        placed.join(F.broadcast(sizes), "feature")  # one row per feature
        .withColumn("first", F.explode(F.sequence("upto", F.col("upto") - F.col("n") + 1, F.lit(-QQ_CHUNK))))
        .withColumn("last_before", F.greatest(F.col("first") - QQ_CHUNK, F.col("upto") - F.col("n")))
        .select("feature", "value", "size", "first", "last_before")
        .repartition("feature", "first")
        .withColumn("place", F.explode(F.sequence(F.col("last_before") + 1, F.col("first"))))
    )
    size, place = F.col("size").cast("double"), F.col("place")
    edge = F.pow(F.lit(0.5), F.lit(1.0) / size)
    probability = (
        F.when(place == 1, F.lit(1.0) - edge)
        .when(place == F.col("size"), edge)
        .otherwise((place - F.lit(0.3175)) / (size + F.lit(0.365)))
    )
    return runs.select(
        "feature", "place", inverse_normal(probability).alias("theoretical"),
        F.col("value").cast("double").alias("ordered"),
    )


def qq_line(points: DataFrame) -> DataFrame:
    """The least-squares line through the points and its r, per feature."""
    return points.groupBy("feature").agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("ordered", "theoretical").alias("r"),
        F.count("*").alias("n"),
    )

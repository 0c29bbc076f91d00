"""Running sums, ranks and order statistics over whole tables without a one-task sort.

A window without a partition key sends every row to one task. Here rows are first cut
into buckets that respect the order; each bucket is summed on its own, and the totals of
the buckets before it are added. Those are summed the same way, by coarse buckets, so
that only the totals of coarse buckets meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom.functions.codes import q

# an integer bucket of this width holds at most this many distinct values
INTEGER_BUCKET = 1 << 16
# buckets of fractions in each doubling of the value, and the doublings of doubles below 1
FRACTION_STEPS = 1 << 16
DOUBLINGS_BELOW_ONE = 1_075
# buckets whose totals are summed together: doubles have 67,233 such groups at most, integers one
# for each 2^28 values
COARSE = 1 << 12
# hex digits of a digest that each pass of a rank search adds, of the digits it has
HASH_STEP_DIGITS = 3
HASH_DIGITS = 32
# rows a rank search may order at its end
HASH_ORDERED_ROWS = 100_000


def running_sums(
    df: DataFrame, keys: Sequence[str], bucket: str, order: str, sums: dict[str, str],
    descending: bool = False,
) -> DataFrame:
    """Add inclusive running sums, ``sums`` mapping new column to summed column.

    Rows must be unique by (keys, order), and ``bucket`` must not decrease as ``order``
    grows. Rows shuffle once, by (keys, bucket). The totals have one row per bucket; they
    join on the same keys, so the rows do not move again. The totals themselves shuffle by
    (keys, coarse bucket), and only coarse totals are summed by ``keys`` alone.
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    within = (
        Window.partitionBy(*keys, bucket)
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    def earlier(by: Sequence[str], place: str):
        return Window.partitionBy(*by).orderBy(direction(place)).rowsBetween(Window.unboundedPreceding, -1)

    def before(name: str, by: Sequence[str], place: str) -> Column:
        return F.coalesce(F.sum(name).over(earlier(by, place)), F.lit(0))

    totals = df.groupBy(*keys, bucket, F.floor(F.col(bucket) / F.lit(COARSE)).alias("__coarse")).agg(
        *[F.sum(source).alias(f"__{name}") for name, source in sums.items()]
    )
    coarse = totals.groupBy(*keys, "__coarse").agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in sums])
    coarse = coarse.select(*keys, "__coarse", *[before(f"__{n}", keys, "__coarse").alias(f"__{n}_coarse") for n in sums])
    inside = totals.withColumns({f"__{n}": before(f"__{n}", [*keys, "__coarse"], bucket) for n in sums})
    offsets = inside.join(coarse, [*keys, "__coarse"]).select(
        *keys, bucket, *[(F.col(f"__{n}") + F.col(f"__{n}_coarse")).alias(f"__{n}") for n in sums],
    )
    local = df.withColumns({n: F.sum(source).over(within) for n, source in sums.items()})
    joined = local.join(offsets, [*keys, bucket])
    return joined.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop(
        *[f"__{n}" for n in sums]
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str, count: str = "n") -> DataFrame:
    """One row per distinct value: a value shared by a third of all rows becomes one row."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias(count))


def with_bucket(df: DataFrame, value: str, bucket: str = "bucket") -> DataFrame:
    """Cut a column of distinct values into ordered buckets, by the value alone.

    Integers are cut by width, which bounds the distinct values in a bucket. Fractions are
    cut by their logarithm, 65,536 buckets to a doubling on either side of zero: however
    many rows there are, nothing is counted beforehand. A bucket spans a hundred-thousandth of
    its value; one that holds more distinct values than fit in memory spills in its sort. Zero, infinities and NaN, the last of all, have buckets of their own.
    """
    x = F.col(value)
    if isinstance(df.schema[value].dataType, T.IntegralType):
        return df.withColumn(bucket, F.floor(x / F.lit(INTEGER_BUCKET)))
    # 1 and more below the least double; log2 is monotonic, and so is what follows
    size = F.least(F.log2(F.abs(x)) + F.lit(DOUBLINGS_BELOW_ONE + 1.0), F.lit(2_101.0))
    step = F.floor(size * F.lit(float(FRACTION_STEPS)))
    number = (
        F.when(F.isnan(x), F.lit(2_102 * FRACTION_STEPS))
        .when(x > 0, step).when(x < 0, -step).otherwise(F.lit(0))
    )
    return df.withColumn(bucket, number.cast("bigint"))


@dataclass(frozen=True)
class HashCuts:
    """Digests that cut each group at exact ranks; the fitted state of a random split."""

    group: str
    by_group: dict

    def above(self, digest: Column) -> Column:
        """How many of its group's cuts lie below the row: a projection, no join."""
        number = None
        for value, cuts in self.by_group.items():
            count = sum(((digest > c).cast("int") for c in cuts), F.lit(0))
            test = q(self.group).eqNullSafe(F.lit(value))
            number = F.when(test, count) if number is None else number.when(test, count)
        return F.lit(0) if number is None else number


def fit_hash_cuts(
    df: DataFrame, group: str, digest: Column, ranks: Sequence[Callable[[int, object], int]]
) -> HashCuts:
    """Find, per group, the digests at ``ranks``, functions of (row count, group value).

    Rows at or below the first cut then number exactly the first rank, and so on. One pass
    counts digest prefixes, 4,096 per group; passes over ever longer prefixes narrow each
    rank down to a few rows, which alone are ordered. Only the counts and the cuts are
    collected, so ``group`` must have few values, such as a class label.
    """
    keyed = df.select(q(group).alias("g"), digest.alias("digest"))
    # (group, prefix) of a cell to the cuts in it and the rows of the group before it
    open_: dict = {}
    found: dict = {}
    length = 0
    while True:
        length += HASH_STEP_DIGITS
        rows = keyed if not found else keyed.where(_in_cells(open_))
        counts: dict = {}
        prefix = F.substring("digest", 1, length).alias("prefix")
        for r in rows.groupBy("g", prefix).agg(F.count("*").alias("n")).collect():
            counts.setdefault((r["g"], r["prefix"][: length - HASH_STEP_DIGITS]), []).append(
                (r["prefix"], r["n"])
            )
        if not found:
            for (value, _), cells in counts.items():
                size = sum(n for _, n in cells)
                wanted = [int(rank(size, value)) for rank in ranks]
                found[value] = [""] * len(ranks)
                open_[value, ""] = ([(c, w) for c, w in enumerate(wanted) if w > 0], 0)
        narrowed: dict = {}
        largest = 0
        for (value, parent), (cuts, before) in open_.items():
            for cell, n in sorted(counts.get((value, parent), ())):
                inside = [(c, w) for c, w in cuts if before < w <= before + n]
                if inside:
                    narrowed[value, cell] = (inside, before)
                    largest = max(largest, n)
                before += n
        open_ = narrowed
        if not open_:
            return HashCuts(group, found)
        if largest <= HASH_ORDERED_ROWS or length >= HASH_DIGITS:
            break
    at = F.row_number().over(Window.partitionBy("g", "prefix").orderBy("digest"))
    places = {
        (value, cell, w - before): []
        for (value, cell), (cuts, before) in open_.items() for _, w in cuts
    }
    for (value, cell), (cuts, before) in open_.items():
        for c, w in cuts:
            places[value, cell, w - before].append(c)
    hits = (
        keyed.where(_in_cells(open_))
        .select("g", "digest", F.substring("digest", 1, length).alias("prefix"))
        .withColumn("at", at)
        .where(F.col("at").isin(sorted({place for _, _, place in places})))
        .collect()
    )
    for r in hits:
        for c in places.get((r["g"], r["prefix"], r["at"]), ()):
            found[r["g"]][c] = r["digest"]
    return HashCuts(group, found)


def _in_cells(cells) -> Column:
    test = F.lit(False)
    for value, prefix in cells:
        test = test | (F.col("g").eqNullSafe(F.lit(value)) & F.col("digest").startswith(prefix))
    return test

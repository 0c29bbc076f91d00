"""The feature view and the column-level preparation around it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import catalog as cat
from riskloom.functions import codes
from riskloom.functions.codes import q


def feature_view(raw: DataFrame, keep: Sequence[str] = (cat.KEY,)) -> DataFrame:
    """The 98-column view: raw columns, ratio, age bands, decoded texts and flags.

    One narrow projection over the scan. ``keep`` passes key columns through beside it.
    """
    columns = [f"`{name}`" for name in (*keep, *cat.RAW_ORDER)]
    columns += [codes.monthly_amount(), codes.age_group(), *codes.age_flags()]
    for attribute in cat.ATTRIBUTES:
        if attribute.repeats:
            columns.append(f"`{attribute.repeats}` as `{cat.repeat_name(attribute.repeats)}`")
        columns += [codes.decoded(attribute), *codes.flags(attribute)]
    return raw.selectExpr(*columns)


def register_view(raw: DataFrame, name: str = "v_credit_features", keep: Sequence[str] = ()) -> None:
    """Create or replace the view as a lazily planned relation."""
    feature_view(raw, keep).createOrReplaceTempView(name)


def rename(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Rename by mapping in one projection; unlisted columns keep their names."""
    names = cat.display_names() if names is None else names
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def map_values(df: DataFrame, maps: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Replace values by mapping; values a mapping lacks become missing."""
    maps = cat.VALUE_NAMES if maps is None else maps
    return df.withColumns(
        {name: codes.lookup(q(name), pairs) for name, pairs in maps.items() if name in df.columns}
    )


def fill_unknown(df: DataFrame, names: Iterable[str] = cat.FILLED, text: str = "Unknown") -> DataFrame:
    present = [n for n in names if n in df.columns]
    return df.na.fill(text, subset=[f"`{n}`" for n in present]) if present else df


def with_target(df: DataFrame) -> DataFrame:
    return df.withColumn("Target", codes.target())


def with_sex(df: DataFrame, status: str = "status_sex_desc") -> DataFrame:
    return df.withColumn("Sex", codes.sex(q(status)))


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    kept = [*keep, *[n for n in numeric_columns(df) if n not in keep]]
    return df.select(*[q(n) for n in kept])


def categories(df: DataFrame, names: Sequence[str], limit: int = 2_000) -> dict[str, list[str]]:
    """The sorted distinct values of each text column.

    The distinct runs on all executors in one pass. Its result becomes columns, so more
    than ``limit`` of them is an input error and stops the job.
    """
    if not names:
        return {}
    values = (
        df.select(*[q(n).alias(f"c{i}") for i, n in enumerate(names)])
        .unpivot([], [f"c{i}" for i in range(len(names))], "name", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )
    rows = values.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories to encode")
    found: dict[str, list[str]] = {n: [] for n in names}
    for row in rows:
        found[names[int(row["name"][1:])]].append(row["value"])
    return {n: sorted(values) for n, values in found.items()}


def one_hot(
    df: DataFrame, names: Sequence[str], values: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Replace text columns by 0/1 columns, one per value but the first; missing is all 0.

    Pass ``values`` found on the training rows to encode other rows the same way.
    """
    values = categories(df, names) if values is None else values
    kept = [q(n) for n in df.columns if n not in names]
    dummies = [
        q(n).eqNullSafe(F.lit(v)).cast("int").alias(f"{n}_{v}")
        for n in names
        for v in values[n][1:]
    ]
    return df.select(*kept, *dummies)

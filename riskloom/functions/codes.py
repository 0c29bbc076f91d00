"""Expressions that decode and flag coded attributes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import catalog as cat


def q(name: str) -> Column:
    """A column by its literal name, whatever characters the name holds."""
    return F.col(f"`{name}`")


def lookup(value: Column, pairs: Mapping) -> Column:
    """The mapped value; NULL for keys the mapping lacks."""
    found = None
    for key, text in pairs.items():
        found = F.when(value == key, text) if found is None else found.when(value == key, text)
    return F.lit(None) if found is None else found


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The view's columns are SQL text and go to the JVM in one ``selectExpr``. As Column
# objects they took some four hundred round trips, seconds of driver time for every plan.


def decoded(attribute: cat.Attribute) -> str:
    """The decoded text, ``unknown`` for a missing or unlisted code."""
    pairs = ", ".join(
        f"{_literal(code)}, {_literal(text)}"
        for code, text, _, _ in attribute.codes
        if text is not None
    )
    found = f"element_at(map({pairs}), `{attribute.raw}`)"
    return f"coalesce({found}, {_literal(cat.UNKNOWN)}) as `{attribute.decoded}`"


def flags(attribute: cat.Attribute) -> list[str]:
    """One 0/1 column per code, NULL where the code is NULL."""
    return [
        f"int(`{attribute.raw}` = {_literal(code)}) as `{flag}`"
        for code, _, flag, _ in attribute.codes
    ]


def monthly_amount() -> str:
    """Amount per month of duration; NULL when either is missing or the duration is 0."""
    return f"try_divide(double(`{cat.AMOUNT}`), `{cat.DURATION}`) as `{cat.RATIO}`"


_AGE_TESTS = (f"`{cat.AGE}` < 25", f"`{cat.AGE}` between 25 and 40", f"`{cat.AGE}` > 40")


def age_group() -> str:
    """Three age bands; a missing age falls through to the last one."""
    young, middle, _ = _AGE_TESTS
    first, second, last = cat.AGE_TEXTS
    return f"if({young}, '{first}', if({middle}, '{second}', '{last}')) as `{cat.AGE_GROUP}`"


def age_flags() -> list[str]:
    return [f"int({test}) as `{name}`" for test, name in zip(_AGE_TESTS, cat.AGE_FLAGS)]


def target(label: Column | None = None) -> Column:
    """1 for a good risk, 0 for a bad one, NULL for any other label."""
    label = q(cat.LABEL) if label is None else label
    return lookup(label, {1: 1, 2: 0}).alias("Target")


def risk_name(label: Column | None = None) -> Column:
    label = q(cat.LABEL) if label is None else label
    return lookup(label, cat.RISK_NAMES).alias("risk")


def sex(status: Column) -> Column:
    """1 when the status text starts with an m in either case, else 0."""
    return F.coalesce((F.lower(F.substring(status, 1, 1)) == "m").cast("int"), F.lit(0)).alias("Sex")

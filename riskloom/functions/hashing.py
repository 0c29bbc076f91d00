"""Pseudo-random numbers that depend on row keys only.

``rand()`` changes with partitioning and with task retries. These values are a function of
seed, purpose and key, so any rerun, on any layout, draws the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13  # 52 bits, exact in a double


def hash_key(seed: int, purpose: str, *keys: Column) -> Column:
    """A hex digest that orders rows at random."""
    parts = [F.lit(f"{seed}:{purpose}"), *[k.cast("string") for k in keys]]
    return F.md5(F.concat_ws(":", *parts))


def hash_uniform(seed: int, purpose: str, *keys: Column) -> Column:
    """A number in [0, 1)."""
    head = F.substring(hash_key(seed, purpose, *keys), 1, _DIGITS)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(16**_DIGITS))

"""The inverse of the standard normal distribution, as a Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# P. J. Acklam's published rational approximation (relative error < 1.15e-9).
CENTRE_NUM = (
    -3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
    1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00,
)
CENTRE_DEN = (
    -5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
    6.680131188771972e01, -1.328068155288572e01, 1.0,
)
TAIL_NUM = (
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
    -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00,
)
TAIL_DEN = (
    7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
    3.754408661907416e00, 1.0,
)
TAIL_BELOW = 0.02425


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def inverse_normal(p: Column) -> Column:
    """The quantile of probability ``p``, 0 < p < 1."""
    centred = p - F.lit(0.5)
    square = centred * centred
    centre = centred * _polynomial(square, CENTRE_NUM) / _polynomial(square, CENTRE_DEN)
    depth = F.sqrt(F.lit(-2.0) * F.log(F.least(p, F.lit(1.0) - p)))
    tail = _polynomial(depth, TAIL_NUM) / _polynomial(depth, TAIL_DEN)
    return (
        F.when(p < TAIL_BELOW, tail)
        .when(p > 1.0 - TAIL_BELOW, -tail)
        .otherwise(centre)
    )

"""Numeric Column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the double itself."""
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, 0 where ``bottom`` is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def sigmoid(value: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-value))

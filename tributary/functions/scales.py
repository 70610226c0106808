"""Number helpers: shares, display sizes and widths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def at_least_one(x: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(x))


def root_scale(x: Column, low: Column, high: Column) -> Column:
    """500 to 2500 by the square root of where x lies between low and high; 800 if all are equal."""
    share = F.sqrt(F.greatest(x - low, F.lit(0.0))) / F.sqrt(F.greatest(high - low, F.lit(1e-9)))
    return F.when(high > low, 500 + 2000 * share).otherwise(800.0)


def radius_scale(x: Column, high: Column) -> Column:
    """4 to 38 by the square root of x relative to the largest value."""
    return 4 + 34 * F.sqrt(F.try_divide(x, high))


def line_width(weight: Column, heaviest: Column) -> Column:
    return 0.5 + 2.5 * F.try_divide(weight, heaviest)


def stroke_width(weight: Column) -> Column:
    return F.greatest(F.lit(0.5), F.sqrt(weight) * 0.8)

"""Numeric helpers with the NULL rules the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one input of the group is NULL.

    Spark's ``sum`` skips NULLs, which would report a partial ``users`` total
    for a group that mixes merged sites (no user count) and plain ones.
    """
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division whose result is NULL, never NaN or infinite, for a zero divisor."""
    return F.try_divide(numerator, denominator)


def percent_change(current: Column, base: Column) -> Column:
    return ratio(current - base, base) * 100

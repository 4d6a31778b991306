"""Exact ratios.  Money stays decimal until the last rounding, so results do not depend on partition order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(amount: Column) -> Column:
    """Sum of a money column, wide enough for any table."""
    return F.sum(amount).cast("decimal(38,2)")


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """``numerator / denominator`` rounded half up; NULL where the denominator is 0.

    The operands fit 10^18 with two decimals each, which leaves the quotient 18 decimals: enough that rounding it
    to ``places`` equals rounding the exact fraction.
    """
    over = F.nullif(denominator.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    return F.round(numerator.cast("decimal(20,2)") / over, places)


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` as a percentage of ``whole``, both counts; NULL where ``whole`` is 0."""
    over = F.nullif(whole.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return F.round(part.cast("decimal(19,0)") * F.lit(100) / over, places)


def as_count(flag: Column) -> Column:
    """How many rows have ``flag`` true; 0 rather than NULL when none has."""
    return F.coalesce(F.sum(flag.cast("int")), F.lit(0)).cast("bigint")

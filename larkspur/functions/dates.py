"""Date expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _forward_months(start: Column, end: Column) -> Column:
    apart = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return apart - F.when(F.dayofmonth(end) < F.dayofmonth(start), 1).otherwise(0)


def whole_months(start: Column, end: Column) -> Column:
    """Complete calendar months from ``start`` to ``end``; negative, symmetrically, when ``end`` comes first.

    ``months_between`` is not used: it counts any two month-ends as a full month apart.
    """
    return F.when(end >= start, _forward_months(start, end)).otherwise(-_forward_months(end, start))


def months_until(start: Column, end: Column, as_of: date) -> Column:
    """Whole months from ``start`` to ``end``, or to ``as_of`` while ``end`` is open."""
    return whole_months(start, F.coalesce(end, F.lit(as_of)))


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMM")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def period_start(day: Column, grain: str) -> Column:
    """First day of the month or week, or the day itself."""
    return F.to_date(day) if grain == "day" else F.trunc(day, grain)


def shift_period(start: Column, grain: str, steps: int) -> Column:
    """The period ``steps`` after the one that begins at ``start``."""
    if grain == "month":
        return F.add_months(start, steps)
    return F.date_add(start, steps * {"day": 1, "week": 7}[grain])

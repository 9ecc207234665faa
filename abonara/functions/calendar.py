"""Period arithmetic on dates.

All helpers take and return DATE columns, so that month or quarter columns can be
partition columns and equi-join keys without casts.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GRAINS = ("day", "week", "month", "quarter")


def period_of(date: Column, grain: str = "month") -> Column:
    """First day of the period that holds ``date`` (weeks start on Monday)."""
    if grain == "day":
        return F.to_date(date)
    if grain in ("week", "month", "quarter"):
        return F.trunc(date, grain)
    raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def shift_period(date: Column, n: int, grain: str = "month") -> Column:
    """Move a date ``n`` periods."""
    if grain == "day":
        return F.date_add(date, n)
    if grain == "week":
        return F.date_add(date, 7 * n)
    if grain == "month":
        return F.add_months(date, n)
    if grain == "quarter":
        return F.add_months(date, 3 * n)
    raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def period_end(date: Column, grain: str = "month") -> Column:
    """Last day of the period that holds ``date``."""
    return F.date_sub(shift_period(period_of(date, grain), 1, grain), 1)


def in_period(date: Column, period: Column, grain: str = "month") -> Column:
    """Does ``date`` lie in the period that starts on ``period``?

    Compares the bare date, so a constant period prunes date partitions and reaches the
    scan; comparing :func:`period_of` would not.
    """
    return date.between(period, F.date_sub(shift_period(period, 1, grain), 1))


def boundary_day(date: Column, boundary: str, grain: str = "month") -> Column:
    """Predicate: is ``date`` the boundary day of its period?

    ``last`` is the closing day, ``second`` the day after the opening day.
    """
    if boundary == "last":
        return date == period_end(date, grain)
    if boundary == "second":
        return date == F.date_add(period_of(date, grain), 1)
    raise ValueError("boundary must be 'last' or 'second'")


def complete_months(start: Column, end: Column) -> Column:
    """Number of complete months from ``start`` to ``end`` (negative backwards).

    A month is complete when the earlier date moved that many months does not pass the
    later one; month ends clamp (30 January plus one month is 28 February), which the
    built-in ``timestampdiff`` does not do.
    """
    def forward(a: Column, b: Column) -> Column:
        calendar = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        return calendar - F.when(F.add_months(a, calendar) > b, 1).otherwise(0)

    return F.when(start <= end, forward(start, end)).when(start > end, -forward(end, start))


def complete_weeks(start: Column, end: Column) -> Column:
    """Whole weeks between two dates, truncated toward zero."""
    return (F.datediff(end, start) / 7).cast("int")


def period_index(start: Column, date: Column, grain: str = "month") -> Column:
    """How many periods ``date``'s period lies after ``start``'s period."""
    months = (F.year(date) - F.year(start)) * 12 + F.month(date) - F.month(start)
    if grain == "month":
        return months
    if grain == "quarter":
        return (F.year(date) - F.year(start)) * 4 + F.quarter(date) - F.quarter(start)
    days = F.datediff(period_of(date, grain), period_of(start, grain))
    return days if grain == "day" else (days / 7).cast("int")


def day_key_to_date(key: Column) -> Column:
    """Decode ``yyyymmdd`` (integer or text) to a date; junk becomes null."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")

"""Calendar expressions. All stay inside Catalyst."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

AsOf = dt.date | str | None


def clock(as_of: AsOf) -> Column:
    """The valuation date: the given one, else today's."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_spine(start: Column, following: int = 12) -> Column:
    """Array of month starts: the month of ``start`` and ``following`` more."""
    first = month_start(start)
    return F.sequence(first, F.add_months(first, following), F.expr("interval 1 month"))


def years_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("double") / F.lit(365.25)


_CLOCK_UNITS = {"hour": "hours", "minute": "mins", "second": "secs"}


def date_shift(value: Column, unit: str, n: int | Column) -> Column:
    """Move a date or timestamp by ``n`` units and return a timestamp.

    Units: day, month, year, hour, minute, second, singular or plural, any
    case. An unknown unit counts as days. Month ends are clamped.
    """
    amount = n if isinstance(n, Column) else F.lit(n)
    name = unit.lower().removesuffix("s")
    moment = value.cast("timestamp")
    if name == "month":
        return moment + F.make_ym_interval(F.lit(0), amount)
    if name == "year":
        return moment + F.make_ym_interval(amount, F.lit(0))
    field = _CLOCK_UNITS.get(name, "days")
    return moment + F.make_dt_interval(**{field: amount})

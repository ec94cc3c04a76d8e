"""Date helpers. The measurement date is always passed in, never read from the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def months_ago(as_of, n: int) -> Column:
    return F.add_months(day(as_of), -n)


def days_ago(as_of, n: int) -> Column:
    return F.date_sub(day(as_of), n)


def days_since(c: Column, as_of) -> Column:
    return F.datediff(day(as_of), c)


def month_boundaries(start: Column, end) -> Column:
    """Calendar months crossed, regardless of the day within the month."""
    end = day(end)
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def year_boundaries(start: Column, end) -> Column:
    return F.year(day(end)) - F.year(start)


def tenure_months(start: Column, as_of, mode: str = "months_between") -> Column:
    """Three definitions are in use: 30-day months, fractional calendar months, month boundaries."""
    if mode == "days_30":
        return F.floor(days_since(start, as_of) / 30)
    if mode == "months_between":
        return F.months_between(day(as_of), start)
    if mode == "boundaries":
        return month_boundaries(start, as_of)
    raise ValueError(f"unknown tenure mode: {mode}")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def fiscal_year(c: Column, first_month: int = 7) -> Column:
    """A fiscal year carries the number of the calendar year in which it ends."""
    return F.year(c) + (F.month(c) >= first_month).cast("int")


def fiscal_month(c: Column, first_month: int = 7) -> Column:
    return F.pmod(F.month(c) - first_month, F.lit(12)) + 1


def fiscal_quarter(c: Column, first_month: int = 7) -> Column:
    return F.floor((fiscal_month(c, first_month) - 1) / 3).cast("int") + 1


def fiscal_year_start(as_of: dt.date, first_month: int = 7) -> dt.date:
    year = as_of.year if as_of.month >= first_month else as_of.year - 1
    return dt.date(year, first_month, 1)

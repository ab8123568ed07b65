"""Calendar arithmetic."""

from __future__ import annotations

import calendar as _cal
import datetime as dt

from pyspark.sql import Column, functions as F


def week_of_year(day: Column) -> Column:
    """Monday-start week number where week 1 is the week of 1 January (not ISO)."""
    first = F.trunc(day, "YEAR")
    return (F.floor((F.dayofyear(day) - 1 + F.weekday(first)) / 7) + 1).cast("int")


def week_of_month(day: Column) -> Column:
    first = F.trunc(day, "MM")
    return (F.floor((F.dayofmonth(day) - 1 + F.weekday(first)) / 7) + 1).cast("int")


def month_index(day: Column) -> Column:
    """Months since year 0, so neighbouring months differ by one."""
    return F.year(day) * 12 + F.month(day) - 1


def add_months(day: dt.date, n: int) -> dt.date:
    index = day.year * 12 + day.month - 1 + n
    year, month = divmod(index, 12)
    return dt.date(year, month + 1, min(day.day, _cal.monthrange(year, month + 1)[1]))


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def month_end(day: dt.date) -> dt.date:
    return day.replace(day=_cal.monthrange(day.year, day.month)[1])

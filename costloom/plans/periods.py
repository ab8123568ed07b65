"""Time intelligence: to-date, rolling and prior-period totals.

Each total is a plain date filter over a daily table; a report period becomes two
dates here, computed on the driver from the last date in context, so the
filter is a literal the scan can prune with.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import add_months, month_end, month_index, month_start

# Months covered by each rolling window.
ROLLING = {"L3M": 3, "L6M": 6, "L9M": 9, "MAT": 12}
TO_DATE = ("MTD", "QTD", "WTD", "YTD")


def last_context_date(fact: DataFrame, day: str = "usage_dt") -> dt.date:
    """The calendar ends with the month of the newest row. One aggregate."""
    return month_end(fact.agg(F.max(day)).first()[0])


def first_context_date(fact: DataFrame, day: str = "usage_dt") -> dt.date:
    return month_start(fact.agg(F.min(day)).first()[0])


def period_bounds(period: str, as_of: dt.date, prior: bool = False,
                  first: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Inclusive first and last day of ``period`` for the last date in context.

    Periods: ``CURRENT`` (needs ``first``), ``MTD``, ``QTD``, ``WTD``, ``YTD``, the
    rolling ``L3M``/``L6M``/``L9M``/``MAT``, and ``PRIOR MONTH`` (needs ``first``).
    ``prior`` shifts to-date periods a year back; a rolling one becomes the whole
    months before the window that ends with the month in context.
    """
    if period == "PRIOR MONTH":
        start = add_months(month_start(first), -1)
        return start, month_end(start)
    if period in ROLLING:
        n = ROLLING[period]
        if prior:
            month = month_start(as_of)
            return add_months(month, -(2 * n - 1)), month_end(add_months(month, -n))
        back = add_months(as_of, -n)
        if as_of == month_end(as_of):
            back = month_end(back)
        return back + dt.timedelta(days=1), as_of
    end = add_months(as_of, -12) if prior else as_of
    if period == "CURRENT":
        return (add_months(first, -12) if prior else first), end
    if period == "MTD":
        return month_start(end), end
    if period == "QTD":
        return dt.date(end.year, 3 * ((end.month - 1) // 3) + 1, 1), end
    if period == "YTD":
        return dt.date(end.year, 1, 1), end
    if period == "WTD":
        # Weeks restart with the year, as in the calendar.
        return max(end - dt.timedelta(days=end.weekday()), dt.date(end.year, 1, 1)), end
    raise ValueError(f"unknown period {period!r}")


def period_total(
    daily: DataFrame,
    value: str,
    period: str,
    as_of: dt.date | None = None,
    prior: bool = False,
    by: Sequence[str] = (),
    first: dt.date | None = None,
    day: str = "usage_dt",
    out: str = "total_nb",
) -> DataFrame:
    """Total of ``value`` over one period, per ``by``."""
    if as_of is None:
        as_of = last_context_date(daily, day)
    if first is None and period in ("CURRENT", "PRIOR MONTH"):
        first = first_context_date(daily, day)
    lo, hi = period_bounds(period, as_of, prior, first)
    return daily.filter(F.col(day).between(F.lit(lo), F.lit(hi))).groupBy(*by).agg(F.sum(value).alias(out))


def period_table(
    daily: DataFrame,
    value: str,
    as_of: dt.date | None = None,
    by: Sequence[str] = (),
    day: str = "usage_dt",
) -> DataFrame:
    """All current and prior totals side by side, one row per ``by``: a single pass with
    one conditional sum per period."""
    if as_of is None:
        as_of = last_context_date(daily, day)
    sums = []
    for period in [*TO_DATE, *ROLLING]:
        for prior in (False, True):
            lo, hi = period_bounds(period, as_of, prior)
            name = f"{period.lower()}{'_prior' if prior else ''}"
            inside = F.col(day).between(F.lit(lo), F.lit(hi))
            sums.append(F.sum(F.when(inside, F.col(value))).alias(name))
    return daily.groupBy(*by).agg(*sums)


def monthly_trend(fact: DataFrame, value: str, by: Sequence[str] = (), day: str = "usage_dt") -> DataFrame:
    """Per month: total, year to date, rolling 12 months, same month last year, the month
    before, and the changes against both.

    The fact is reduced to months first; windows run over at most one row per month
    and group. Look-backs are range frames on a month number, so a month without
    data is a gap, not its neighbour's value.
    """
    month = month_index(F.col(day))
    monthly = fact.groupBy(*by, F.year(day).alias("year"), F.month(day).alias("month_nb"),
                           month.alias("__m")).agg(F.sum(value).alias("cost"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    line = group.orderBy("__m")
    year = Window.partitionBy(*by, "year").orderBy("__m").rowsBetween(Window.unboundedPreceding, 0)
    full = (
        monthly.withColumn("ytd", F.sum("cost").over(year))
        .withColumn("mat", F.sum("cost").over(line.rangeBetween(-11, 0)))
        .withColumn("ly", F.sum("cost").over(line.rangeBetween(-12, -12)))
        .withColumn("prior_month", F.sum("cost").over(line.rangeBetween(-1, -1)))
    )
    change = F.col("cost").cast("double") - F.col("ly").cast("double")
    step = F.col("cost").cast("double") - F.col("prior_month").cast("double")
    return full.select(
        *by, "year", "month_nb", "cost", "ytd", "mat", "ly", "prior_month",
        F.try_divide(change, F.col("ly").cast("double")).alias("yoy_pct"),
        step.alias("vs_prior_month"),
        F.try_divide(step, F.col("prior_month").cast("double")).alias("vs_prior_month_pct"),
    )


def period_comparison(fact: DataFrame, value: str, year: int | None, by: Sequence[str] = (),
                      day: str = "usage_dt", out: str = "change_pct") -> DataFrame:
    """``(this year - last year) / last year`` per ``by`` for one selected year.

    NULL when no single year is selected or last year has no value, 0 when last
    year's value is 0.
    """
    if year is None:
        return fact.select(*by).distinct().withColumn(out, F.lit(None).cast("double"))
    y = F.year(day)
    sums = (
        fact.filter(F.col(day).between(F.lit(dt.date(year - 1, 1, 1)), F.lit(dt.date(year, 12, 31))))
        .groupBy(*by)
        .agg(
            F.sum(F.when(y == year, F.col(value))).cast("double").alias("__cur"),
            F.sum(F.when(y == year - 1, F.col(value))).cast("double").alias("__old"),
        )
    )
    gap = F.coalesce("__cur", F.lit(0.0)) - F.col("__old")
    ratio = F.when(F.col("__old").isNotNull(), F.coalesce(F.try_divide(gap, F.col("__old")), F.lit(0.0)))
    return sums.select(*by, ratio.alias(out))

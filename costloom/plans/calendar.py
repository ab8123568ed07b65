"""The reporting calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import week_of_month, week_of_year


def calendar_bounds(fact: DataFrame, day: str = "usage_dt") -> DataFrame:
    """One row: first day of the first month and last day of the last month with data."""
    ends = fact.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return ends.select(F.trunc("lo", "MM").alias("start_dt"), F.last_day("hi").alias("end_dt"))


def calendar_for(fact: DataFrame, day: str = "usage_dt") -> DataFrame:
    """Calendar covering every month of ``fact``. One aggregate, no action."""
    return _attributes(
        calendar_bounds(fact, day).select(
            F.explode(F.sequence("start_dt", "end_dt", F.expr("interval 1 day"))).alias("date")
        )
    )


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("date")
    )
    return _attributes(days)


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _attributes(days: DataFrame) -> DataFrame:
    d = F.col("date")
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    week, first = week_of_year(d), F.trunc(d, "QUARTER").cast("date")
    month_of_quarter = month - (quarter - 1) * 3
    # Both days lie in one year, so the difference of week numbers is the week of the quarter.
    week_of_quarter = week - week_of_year(first) + 1
    two = F.lpad(week.cast("string"), 2, "0")
    return days.select(
        d,
        year.alias("year"),
        quarter.alias("quarter_number"),
        (year * 10 + quarter).alias("quarter_sort_key"),
        _text("Q", quarter.cast("string")).alias("quarter_of_year"),
        _text("Q", quarter.cast("string"), ".", year.cast("string")).alias("quarter"),
        month.alias("month_of_year_number"),
        (year * 100 + month).alias("month_sort_key"),
        F.date_format(d, "MMMM").alias("month_of_year"),
        F.date_format(d, "MMMM yyyy").alias("month"),
        month_of_quarter.alias("month_of_quarter_number"),
        _text("QM", month_of_quarter.cast("string")).alias("month_of_quarter"),
        week.alias("week_of_year_number"),
        (year * 100 + week).alias("week_sort_key"),
        _text("W", two).alias("week_of_year"),
        _text(year.cast("string"), "-W", two).alias("week"),
        week_of_quarter.alias("week_of_quarter_number"),
        _text("QW", week_of_quarter.cast("string")).alias("week_of_quarter"),
        week_of_month(d).alias("week_of_month_number"),
        _text("MW", week_of_month(d).cast("string")).alias("week_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        (F.datediff(d, first) + 1).alias("day_of_quarter"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
    )


# Report axis to calendar column.
GRAINS = {"year": "year", "quarter": "quarter", "month": "month", "week": "week", "date": "date"}


def by_period(fact: DataFrame, value: str, grain: str, by=(), day: str = "usage_dt",
              out: str = "total_nb") -> DataFrame:
    """Totals on the chosen time axis. Days are summed before the calendar is joined, so
    the join sees one row per day and group, not the fact."""
    column = GRAINS[grain]
    daily = fact.groupBy(day, *by).agg(F.sum(value).alias("__v"))
    if grain == "date":
        return daily.select(F.col(day).alias("date"), *by, F.col("__v").alias(out))
    days = calendar_for(fact, day).select(F.col("date").alias(day), column)
    return daily.join(days, day).groupBy(column, *by).agg(F.sum("__v").alias(out))

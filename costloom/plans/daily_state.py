"""Measures that do not add up, from a state per day that does.

Distinct counts and percentiles cannot be summed over days, so every period form used to scan the fact again. Here each day
keeps what merges exactly: bitmaps of the dense surrogates seen (merged by OR), and the number of times each value was seen (merged
by sum). Any period, to-date, rolling or prior, is then a merge of its days, equal to the same measure on the fact. A day
that is loaded again replaces its rows; other days stay.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import month_index
from ..operators.ranking import percentile_of_counts
from .periods import ROLLING, TO_DATE, last_context_date, period_bounds

DAY = "usage_dt"


def distinct_state(fact: DataFrame, column: str = "resource_id", by: Sequence[str] = (), day: str = DAY) -> DataFrame:
    """``(day, *by, bucket_nb, seen)``: the surrogates of a day, 32,768 to a bitmap. NULL surrogates are not counted.

    Made for dense surrogates, as ``operators.keys`` numbers them. Rows are brought together before bitmaps are made: a task that sees
    few rows of a day would make a bitmap of 4 KB for nearly each of them, to be shuffled and sorted."""
    bits = fact.filter(F.col(column).isNotNull()).select(
        day, *by, F.bitmap_bucket_number(column).alias("bucket_nb"), F.bitmap_bit_position(column).alias("__bit"))
    return _dealt(bits, day, *by, "bucket_nb").groupBy(day, *by, "bucket_nb").agg(F.bitmap_construct_agg("__bit").alias("seen"))


def _dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by ``columns`` to as many tasks as the session shuffles to. Adaptive execution would merge these by their size on disk, which says little
    of what bitmaps take in memory."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def count_state(fact: DataFrame, value: str, by: Sequence[str] = (), day: str = DAY) -> DataFrame:
    """``(day, *by, value, n_nb)``: how often each value was seen on a day. NULL values are not counted."""
    return fact.filter(F.col(value).isNotNull()).groupBy(day, *by, value).agg(F.count(F.lit(1)).alias("n_nb"))


def replace_days(state: DataFrame, fresh: DataFrame, days: Sequence[dt.date], day: str = DAY) -> DataFrame:
    """``state`` with the rows of ``days`` taken from ``fresh``, the state of these days built again."""
    return state.filter(~F.coalesce(F.col(day).isin(list(days)), F.lit(False))).unionByName(fresh)


def _inside(period: str, as_of: dt.date, prior: bool, first: dt.date | None, day: str):
    lo, hi = period_bounds(period, as_of, prior, first)
    return F.col(day).between(F.lit(lo), F.lit(hi))


def distinct_total(state: DataFrame, period: str, as_of: dt.date, prior: bool = False, by: Sequence[str] = (),
                   first: dt.date | None = None, day: str = DAY, out: str = "distinct_nb") -> DataFrame:
    """Distinct surrogates over one period, per ``by``: the period is a literal that the scan can prune with."""
    merged = state.filter(_inside(period, as_of, prior, first, day)).groupBy(*by, "bucket_nb").agg(F.bitmap_or_agg("seen").alias("seen"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("seen")), F.lit(0)).alias(out))


def distinct_table(state: DataFrame, as_of: dt.date | None = None, by: Sequence[str] = (), day: str = DAY) -> DataFrame:
    """All current and prior period forms side by side, as ``periods.period_table``: one pass over the state."""
    as_of = as_of or last_context_date(state, day)
    forms = {f"{p.lower()}{'_prior' if prior else ''}": _inside(p, as_of, prior, None, day) for p in [*TO_DATE, *ROLLING] for prior in (False, True)}
    merged = state.groupBy(*by, "bucket_nb").agg(*(F.bitmap_or_agg(F.when(test, F.col("seen"))).alias(n) for n, test in forms.items()))
    return merged.groupBy(*by).agg(*(F.sum(F.bitmap_count(n)).alias(n) for n in forms))


def distinct_trend(state: DataFrame, by: Sequence[str] = (), day: str = DAY) -> DataFrame:
    """Per month that has data: distinct surrogates of the month, the year to date, the rolling 12 months, the same month last
    year and the month before; NULL where a look-back has no data.

    Days are merged to months first. Each month's bitmaps are then sent to the months that look back on it, at most 26.
    """
    by = list(by)
    months = _dealt(state.select(*by, month_index(F.col(day)).alias("__m"), "bucket_nb", "seen"), *by, "__m", "bucket_nb")
    monthly = months.groupBy(*by, "__m", "bucket_nb").agg(F.bitmap_or_agg("seen").alias("seen"))
    to = lambda form, first, last: F.transform(
        F.sequence(first, last), lambda m: F.struct(F.lit(form).alias("form"), m.alias("m")))
    month = F.col("__m")
    december = month - F.pmod(month, F.lit(12)) + 11
    looks = F.concat(to("month_nb", month, month), to("ytd_nb", month, december), to("mat_nb", month, month + 11),
                     to("ly_nb", month + 12, month + 12), to("prior_month_nb", month + 1, month + 1))
    sent = monthly.withColumn("__to", F.explode(looks)).groupBy(*by, F.col("__to.m").alias("__m"), F.col("__to.form").alias("__form"), "bucket_nb").agg(
        F.bitmap_or_agg("seen").alias("seen"))
    forms = ("month_nb", "ytd_nb", "mat_nb", "ly_nb", "prior_month_nb")
    wide = sent.groupBy(*by, "__m").agg(*(F.sum(F.when(F.col("__form") == f, F.bitmap_count("seen"))).alias(f) for f in forms))
    year = F.floor(F.col("__m") / 12).cast("int")
    number = (F.pmod(F.col("__m"), F.lit(12)) + 1).cast("int")
    return wide.filter("month_nb is not null").select(*by, year.alias("year"), number.alias("month"), *forms)


def percentile_total(state: DataFrame, value: str, p: float, period: str, as_of: dt.date, prior: bool = False, by: Sequence[str] = (),
                     first: dt.date | None = None, day: str = DAY, out: str = "percentile_nb") -> DataFrame:
    """The exact inclusive percentile over one period, from the counts of its days."""
    return percentile_of_counts(state.filter(_inside(period, as_of, prior, first, day)), value, "n_nb", p, by, out)

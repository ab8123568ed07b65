"""Pricing usage lines from validity windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from .compare import _has_map

PRICE_KEYS = ("account_cd", "sku_name_lb", "cloud_lb")


def price_lines(
    usage: DataFrame,
    prices: DataFrame,
    on: Sequence[str] = PRICE_KEYS,
    currency: str | None = None,
    at: str = "usage_end_dt",
    quantity: str = "usage_quantity_nb",
    out: str = "line_cost_usd",
) -> DataFrame:
    """Add the cost of each usage line: quantity times the price in force at ``at``.

    Windows are half open, ``[price_start_dt, price_end_dt)``; a NULL end is
    open. The effective list price wins over the default one. A line without a
    window keeps a NULL cost. The join hashes on ``on`` and tests the window as a
    residual; the price list is neither grouped nor hinted, so it is broadcast
    when its measured size allows and otherwise shuffled, with hot SKUs split.
    """
    if currency is not None:
        prices = prices.filter(F.col("currency_code_lb") == currency)
    side = prices.select(
        *[F.col(c).alias(f"__p_{c}") for c in on],
        F.col("price_start_dt").alias("__from"),
        F.col("price_end_dt").alias("__until"),
        F.coalesce("effective_list_price_nb", "default_price_nb").alias("__price"),
    )
    condition = (F.col(at) >= F.col("__from")) & (
        F.col("__until").isNull() | (F.col(at) < F.col("__until"))
    )
    for c in on:
        condition = condition & (F.col(c) == F.col(f"__p_{c}"))
    return usage.join(side, condition, "left").select(
        *usage.columns, (F.col(quantity) * F.col("__price")).alias(out)
    )


SLICE_DAYS, LANES = 30, 8


def price_lines_asof(
    usage: DataFrame,
    prices: DataFrame,
    on: Sequence[str] = PRICE_KEYS,
    currency: str | None = None,
    at: str = "usage_end_dt",
    quantity: str = "usage_quantity_nb",
    out: str = "line_cost_usd",
    slice_days: int = SLICE_DAYS,
    lanes: int = LANES,
) -> DataFrame:
    """``price_lines`` for long price histories, where a line would meet every window of its SKU.

    Lines and window starts are one stream in time, cut into slices of ``slice_days``. Inside a slice a line takes the
    last price that started before it; where there is none, the last price of all earlier slices, which is
    carried along one row per SKU and slice. The work is a sort of lines and prices, whatever the number of windows. A
    slice's lines are dealt to ``lanes`` tasks, each with the slice's prices, so one SKU's busy days are many tasks'
    work. Windows of one SKU must not overlap (``price_overlaps`` is empty); lines that lack a key part or the
    time are passed by and keep a NULL cost.
    """
    if currency is not None:
        prices = prices.filter(F.col("currency_code_lb") == currency)
    on = list(on)
    kinds, known = ({f.name: f.dataType for f in df.schema.fields} for df in (usage, prices))
    # Plain columns rather than structs: those that no later step reads are not shuffled. Keys and times of one type are not copied.
    key = [c if kinds[c] == known[c] else f"__k{i}" for i, c in enumerate(on)]
    time = at if kinds[at] == known["price_start_dt"] else "__time"
    whole = reduce(lambda a, c: a & c, [F.col(c).isNotNull() for c in [*on, at]])
    slice_of = lambda c: F.floor(F.unix_date(F.to_date(c)) / slice_days).cast("int")
    window = F.struct(F.col("price_end_dt").alias("until"), F.coalesce("effective_list_price_nb", "default_price_nb").alias("price"))
    starts = prices.filter(F.col("price_start_dt").isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(on, key)], slice_of("price_start_dt").alias("__slice"),
        F.col("price_start_dt").alias(time), window.alias("__window"))
    plain = [f"`{f.name}`" for f in usage.schema.fields if not _has_map(f.dataType)]
    deal = F.pmod(F.xxhash64(*plain), F.lit(lanes)).cast("int")
    copies = {k: F.col(c) for c, k in zip([*on, at], [*key, time]) if c != k}
    lines = usage.filter(whole).withColumns({"__slice": slice_of(at), "__lane": deal, "__is_line": F.lit(True), **copies})
    # What each SKU's slices begin with: the last start of any slice before, over one row per SKU and slice.
    ended = starts.groupBy(*key, "__slice").agg(F.max_by("__window", time).alias("__last"))
    asked = lines.select(*key, "__slice").distinct().withColumn("__last", F.lit(None).cast(ended.schema["__last"].dataType))
    slices = ended.unionByName(asked).groupBy(*key, "__slice").agg(F.first("__last", ignorenulls=True).alias("__last"))
    before = Window.partitionBy(*key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(*key, "__slice", F.last("__last", ignorenulls=True).over(before).alias("__window")).filter(
        F.col("__window").isNotNull()).withColumn(time, F.lit(None).cast(starts.schema[time].dataType))
    # The carried price comes first in its slice: a NULL time sorts before all others.
    offered = starts.unionByName(carried).withColumn("__lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    both = lines.unionByName(offered, allowMissingColumns=True)
    along = Window.partitionBy(*key, "__slice", "__lane").orderBy(F.col(time).asc_nulls_first(), F.col("__is_line").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0)
    held = both.withColumn("__held", F.last("__window", ignorenulls=True).over(along)).filter(F.col("__is_line").isNotNull())
    valid = F.col("__held.until").isNull() | (F.col(time) < F.col("__held.until"))
    names = [F.col(f"`{c}`") for c in usage.columns if c != out]
    priced = held.select(*names, F.when(valid, F.col(f"`{quantity}`") * F.col("__held.price")).alias(out))
    rest = usage.filter(~whole).select(*names, F.lit(None).cast(priced.schema[out].dataType).alias(out))
    return priced.unionByName(rest)


def price_overlaps(prices: DataFrame, on: Sequence[str] = PRICE_KEYS) -> DataFrame:
    """Windows that overlap the next one of the same key. Empty means each usage
    line can match at most one price."""
    order = Window.partitionBy(*on).orderBy("price_start_dt", F.col("price_end_dt").asc_nulls_last())
    follow = F.lead("price_start_dt").over(order)
    return (
        prices.withColumn("next_start_dt", follow)
        .filter(
            F.col("next_start_dt").isNotNull()
            & (F.col("price_end_dt").isNull() | (F.col("price_end_dt") > F.col("next_start_dt")))
        )
    )


def reprice(
    cost: DataFrame,
    prices: DataFrame,
    changed: DataFrame,
    on: Sequence[str] = PRICE_KEYS,
    at: str = "usage_end_dt",
    **kwargs,
) -> DataFrame:
    """Cost lines whose price window changed, priced again from ``prices``.

    ``changed`` holds the corrected windows. Only lines inside one of them are
    returned, ready to be merged back over the cost fact.
    """
    windows = changed.select(
        *[F.col(c).alias(f"__c_{c}") for c in on],
        F.col("price_start_dt").alias("__c_from"),
        F.col("price_end_dt").alias("__c_until"),
    )
    hit = (F.col(at) >= F.col("__c_from")) & (
        F.col("__c_until").isNull() | (F.col(at) < F.col("__c_until"))
    )
    for c in on:
        hit = hit & (F.col(c) == F.col(f"__c_{c}"))
    touched = cost.join(windows, hit, "left_semi")
    out = kwargs.get("out", "line_cost_usd")
    return price_lines(touched.drop(out), prices, on, at=at, **kwargs).select(*cost.columns)

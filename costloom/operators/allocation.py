"""Proportional allocation of a cost pool over the items that drew on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .compare import any_null
from .spread import grouped_for_join


def statement_weight(cached: str, total: str, queued: str) -> Column:
    """Billable milliseconds: queue wait is not billed, at least 1 ms, cache hits 0.

    A NULL duration weighs 1 ms.
    """
    ran = F.col(total) - F.coalesce(F.col(queued), F.lit(0))
    return F.when(F.col(cached) == 1, 0).otherwise(F.greatest(ran, F.lit(1)))


def cost_pool(cost: DataFrame, keys: Sequence[str], value: str = "line_cost_usd",
              out: str = "pool_cost_usd") -> DataFrame:
    """Billed cost per ``keys``; lines without the consuming resource are not pooled."""
    return cost.filter(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(F.sum(value).alias(out))


def allocate(
    items: DataFrame,
    pool: DataFrame,
    keys: Sequence[str],
    weight: str,
    *,
    pool_cost: str = "pool_cost_usd",
    even_split: bool = False,
    exempt: Column | None = None,
    no_pool: float | None = None,
    scale: int = 6,
    total_as: str = "total_weight_nb",
    count_as: str | None = None,
    out: str = "attributed_cost_usd",
) -> DataFrame:
    """Give each item its share ``weight / sum(weight)`` of the pool of its ``keys``.

    * items with a NULL key part drop out (no pool could ever match them);
    * ``exempt`` items get 0, and so does everything where all weights are 0,
      unless ``even_split``, which then divides the pool by the item count;
    * items without a pool get ``no_pool``.

    Weights are summed with map-side combine and the totals joined back: a group
    holding a third of all items stays spread over many tasks.
    """
    items = items.filter(~any_null(keys))
    counter = count_as or "__count"
    # Weights and pools are summed in one grouping, so the items are shuffled once,
    # to meet its result.
    weights = items.select(*keys, F.col(weight).alias("__w"), F.lit(1).alias("__one"))
    both = weights.unionByName(pool.select(*keys, pool_cost), allowMissingColumns=True)
    terms = grouped_for_join(
        both, keys, F.sum("__w").alias(total_as), F.count("__one").alias(counter),
        F.sum(pool_cost).alias(pool_cost),
    )
    shared = items.join(terms, list(keys))
    cost, total = F.col(pool_cost).cast("double"), F.col(total_as)
    part = cost * F.try_divide(F.col(weight).cast("double"), total.cast("double"))
    if even_split:
        count = F.col(counter).cast("double")
        part = F.when(total > 0, part).when(
            F.col(counter) > 0, cost * F.try_divide(F.lit(1.0), count)
        ).otherwise(0.0)
    else:
        part = F.when(total == 0, 0.0).otherwise(part)
    if exempt is not None:
        part = F.when(exempt, 0.0).otherwise(part)
    if no_pool is not None:
        part = F.when(F.col(pool_cost).isNull(), F.lit(float(no_pool))).otherwise(part)
    carried = [pool_cost, total_as] + ([count_as] if count_as else [])
    return shared.select(
        *[F.col(f"`{c}`") for c in items.columns], *carried, F.round(part, scale).alias(out)
    )


def reconcile(attributed: DataFrame, pool: DataFrame, keys: Sequence[str],
              pool_cost: str = "pool_cost_usd", share: str = "attributed_cost_usd") -> DataFrame:
    """Pool, allocated sum, what is left and the item count per key, pools without items
    included."""
    used = attributed.groupBy(*keys).agg(
        F.sum(share).alias("allocated_usd"), F.count(F.lit(1)).alias("items_nb")
    )
    given = F.coalesce(F.col("allocated_usd"), F.lit(0.0))
    return pool.select(*keys, pool_cost).join(used, list(keys), "left").select(
        *keys,
        F.col(pool_cost),
        given.alias("allocated_usd"),
        (F.col(pool_cost).cast("double") - given).alias("residual_usd"),
        F.coalesce("items_nb", F.lit(0)).alias("items_nb"),
    )

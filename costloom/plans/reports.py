"""Report queries over the gold facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .measures import cost_share, measure, top

TAG_NAME, NO_VALUE = "Appid", "Untagged"


def cost_by(fact: DataFrame, by: Sequence[str], value: str = "total_cost") -> DataFrame:
    return measure(fact, value, by)


def month_start(day: str = "usage_dt") -> Column:
    return F.trunc(day, "MM").cast("date")


def matrix(df: DataFrame, rows: Sequence[str], cols: str, value: str) -> DataFrame:
    """Rows by columns with summed cells; the columns are all values that ``cols`` has.

    Cells are summed first and written to the checkpoint folder, so finding the axis and turning it read the small table only.
    """
    cells = staged(df.groupBy(*rows, cols).agg(F.sum(value).alias("__cell")))
    return cells.groupBy(*rows).pivot(cols).agg(F.first("__cell", ignorenulls=True))


def resource_detail(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Resources with their cost and share of all cost, dearest first."""
    return cost_share(fact, columns).orderBy(F.col("total_cost").desc(), *columns)


def top_cost(fact: DataFrame, by: Sequence[str], n: int = 10, **kwargs) -> DataFrame:
    return top(fact, "total_cost", by, n, **kwargs)


LEVELS = ["domain_lb", "sub_domain_lb", "application_lb"]


def resources_by_application(
    bridge: DataFrame, keys: DataFrame, apps: DataFrame, tag: str = TAG_NAME, exclude: str = NO_VALUE
) -> DataFrame:
    """Distinct ``(domain, sub-domain, application, resource)`` reached through one tag."""
    wanted = keys.filter(F.lower("tag_key_cd") == tag.lower()).select("tag_key_id")
    return (
        bridge.filter(~F.col("tag_value_lb").contains(exclude))
        .join(wanted, "tag_key_id")
        .join(apps, F.col("tag_value_lb") == F.col("application_cd"))
        .select(*LEVELS, "resource_id")
        .distinct()
    )


def cost_by_tag_domain(
    cost: DataFrame,
    bridge: DataFrame,
    keys: DataFrame,
    apps: DataFrame,
    tag: str = TAG_NAME,
    rollup: bool = False,
    period: Column | None = None,
) -> DataFrame:
    """Cost per domain, sub-domain, application and month.

    A resource counts once per cell but may sit in several domains. ``rollup`` adds
    sub-totals (NULL in the rolled-up columns, ``level_nb`` tells them from missing
    names); each level counts the distinct resources below it, since
    summing cells would count shared resources twice. Cost is reduced to one row per
    resource and month before it meets the applications.
    """
    month = month_start() if period is None else period
    monthly = cost.groupBy("resource_id", month.alias("month_dt")).agg(
        F.sum("line_cost_usd").alias("__cost")
    )
    members = resources_by_application(bridge, keys, apps, tag)
    depths = list(range(len(LEVELS) + 1)) if rollup else [len(LEVELS)]
    # All levels in one pass: a member row stands once in each, with what is rolled up as NULL, and is made distinct there.
    level = F.col("level_nb")
    names = [F.when(level > k, F.col(c)).alias(c) for k, c in enumerate(LEVELS)]
    cells = members.withColumn("level_nb", F.explode(F.array(*map(F.lit, depths)))).select(*names, "resource_id", "level_nb").distinct()
    return cells.join(monthly, "resource_id").groupBy(*LEVELS, "level_nb", "month_dt").agg(
        F.sum("__cost").alias("total_cost")).select(*LEVELS, "month_dt", "total_cost", "level_nb")

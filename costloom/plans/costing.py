"""The priced billing fact and the two cost attributions built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.allocation import allocate, cost_pool
from ..operators.merge import merge
from ..operators.pricing import PRICE_KEYS, price_lines
from .silver import LINE, LINE_KEYS, LOAD, price_view, serving_requests, statements

COST_KEYS = [*LINE_KEYS, LINE]
COST_DAY = "ingestion_dt"
QUERY_KEYS = ["usage_dt", "account_cd", "workspace_cd", "warehouse_cd"]
SERVING_KEYS = ["usage_dt", "account_cd", "workspace_cd", "endpoint_cd"]


def merge_prices(prices: DataFrame, landed: DataFrame, actions: bool = False) -> DataFrame:
    """Fold a full price snapshot in. The start time is part of the key, so closed
    windows stay."""
    return merge_price_rows(prices, price_view(landed), actions)


def merge_price_rows(prices: DataFrame, rows: DataFrame, actions: bool = False) -> DataFrame:
    guard = ["usage_unit_lb", "default_price_nb", "effective_list_price_nb", "price_end_dt"]
    now = F.current_timestamp()
    return merge(
        prices,
        rows,
        [*PRICE_KEYS, "currency_code_lb", "price_start_dt"],
        guard=guard,
        update={**{c: F.col(f"s.{c}") for c in guard}, "sys_update_dt": now},
        insert={"sys_create_dt": now, "sys_update_dt": now},
        actions=actions,
    )


def costed(usage: DataFrame, prices: DataFrame, currency: str | None = "USD") -> DataFrame:
    """Usage lines with their cost; the load time of the usage row is kept as the mark."""
    priced = price_lines(usage, prices, currency=currency)
    return priced.withColumn("usage_load_dt", F.col(LOAD)).withColumn(LOAD, F.current_timestamp())


def merge_cost(cost: DataFrame, fresh: DataFrame) -> DataFrame:
    """Upsert priced lines. ``cost`` may be limited to the ingestion days ``fresh``
    touches; every column is replaced when the cost or the load mark changed, and
    columns or metadata fields only ``fresh`` has are added. Lines that lack a key part
    match by their ``line_cd``, so folding the same lines again changes nothing."""
    return merge(
        cost,
        fresh,
        COST_KEYS,
        guard=["line_cost_usd", "usage_load_dt"],
        update=[c for c in fresh.columns],
        evolve=True,
        null_safe=True,
    )


def warehouse_pool(cost: DataFrame) -> DataFrame:
    lines = cost.withColumn("warehouse_cd", F.col("usage_metadata.warehouse_id"))
    return cost_pool(lines, QUERY_KEYS, out="warehouse_cost_usd")


def endpoint_pool(cost: DataFrame) -> DataFrame:
    lines = cost.withColumn("endpoint_cd", F.col("usage_metadata.endpoint_id"))
    return cost_pool(lines, SERVING_KEYS, out="endpoint_cost_usd")


def query_attribution(query_history: DataFrame, pool: DataFrame) -> DataFrame:
    """Warehouse-day cost over its statements by billable time. Failed and cancelled
    statements count; cache hits cost nothing; a statement belongs to its start day;
    without a pool the share stays NULL."""
    return allocate(
        statements(query_history),
        pool,
        QUERY_KEYS,
        "billable_duration_ms_nb",
        pool_cost="warehouse_cost_usd",
        exempt=F.col("from_result_cache_fl") == 1,
        total_as="total_billable_ms_nb",
    )


def serving_attribution(serving_usage: DataFrame, entities: DataFrame, pool: DataFrame) -> DataFrame:
    """Endpoint-day cost over its requests by tokens, evenly when no request has any;
    0 where nothing was billed."""
    return allocate(
        serving_requests(serving_usage, entities),
        pool,
        SERVING_KEYS,
        "total_token_count_nb",
        pool_cost="endpoint_cost_usd",
        even_split=True,
        no_pool=0,
        total_as="daily_total_token_count_nb",
        count_as="daily_total_request_count_nb",
    )

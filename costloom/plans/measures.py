"""Spend and query measures.

A measure is a named aggregate, or a formula over other measures. ``measure``
computes any set of them in one grouped pass; grouping columns and filters take
the place of a report's filter context. Columns are those of the gold facts,
optionally joined to dimension columns with ``star``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ranking import global_rank, percentile_inc, share, top_n
from ..session import ensure_checkpoint_dir

COST, QUERY = "cost", "query"


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _sum_if(test: Column, value: str) -> Column:
    return F.sum(F.when(test, F.col(value)))


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


# Base aggregates: name -> (fact, aggregate).
BASE: dict[str, tuple[str, Callable[[], Column]]] = {
    "total_cost": (COST, lambda: F.sum("line_cost_usd")),
    "total_usage_quantity": (COST, lambda: F.sum("usage_quantity_nb")),
    "total_usage_dbu": (COST, lambda: _sum_if(_is("usage_unit_lb", "DBU"), "usage_quantity_nb")),
    "serverless_cost": (COST, lambda: _sum_if(_is("is_serverless_fl", "Yes"), "line_cost_usd")),
    "photon_cost": (COST, lambda: _sum_if(_is("is_photon_fl", "Yes"), "line_cost_usd")),
    "active_workspaces": (COST, lambda: F.count_distinct("workspace_id")),
    "active_identities": (COST, lambda: F.count_distinct("identity_id")),
    "active_resources": (COST, lambda: F.count_distinct("resource_id")),
    "days_with_cost": (COST, lambda: F.count_distinct("usage_dt")),
    "latest_data_date": (COST, lambda: F.max("ingestion_dt")),
    "total_query_cost": (QUERY, lambda: F.sum("attributed_cost_usd")),
    "warehouse_cost": (QUERY, lambda: F.sum("warehouse_cost_usd")),
    "total_read_gb": (QUERY, lambda: F.sum("read_gb_nb")),
    "statements": (QUERY, lambda: F.count(F.lit(1))),
    "long_running_statements": (QUERY, lambda: F.count_if(F.col("total_duration_ms_nb") > 300000)),
    "cached_statements": (QUERY, lambda: F.count_if(_is("from_result_cache_fl", "Yes"))),
    "failed_statements": (QUERY, lambda: F.count_if(_is("execution_status_lb", "FAILED"))),
    "failed_statements_cost": (
        QUERY, lambda: _sum_if(_is("execution_status_lb", "FAILED"), "attributed_cost_usd")
    ),
    "query_users": (
        QUERY, lambda: F.count_distinct(F.when(F.col("identity_id") > 0, F.col("identity_id")))
    ),
    "duration_ms": (QUERY, lambda: F.sum("total_duration_ms_nb")),
    "timed_statements": (QUERY, lambda: F.count("total_duration_ms_nb")),
    "wait_ms": (
        QUERY,
        lambda: F.coalesce(F.sum("waiting_at_capacity_ms_nb"), F.lit(0))
        + F.coalesce(F.sum("waiting_for_compute_ms_nb"), F.lit(0)),
    ),
}

# Formulas: name -> (numerator, denominator, factor on the denominator).
RATIOS: dict[str, tuple[str, str, float]] = {
    "avg_daily_cost": ("total_cost", "days_with_cost", 1),
    "avg_cost_per_unit": ("total_cost", "total_usage_quantity", 1),
    "cost_per_workspace": ("total_cost", "active_workspaces", 1),
    "cost_per_identity": ("total_cost", "active_identities", 1),
    "serverless_cost_pct": ("serverless_cost", "total_cost", 1),
    "photon_cost_pct": ("photon_cost", "total_cost", 1),
    "self_ratio": ("total_cost", "total_cost", 1),
    "avg_cost_per_statement": ("total_query_cost", "statements", 1),
    "avg_query_duration_s": ("duration_ms", "timed_statements", 1000),
    "queue_time_share": ("wait_ms", "duration_ms", 1),
    "cache_hit_rate": ("cached_statements", "statements", 1),
    "failed_statement_rate": ("failed_statements", "statements", 1),
    "cost_per_gb_read": ("total_query_cost", "total_read_gb", 1),
    "cost_per_query_user": ("total_query_cost", "query_users", 1),
}
SPECIAL = {"peak_daily_cost": COST, "p90_query_duration_s": QUERY}
NAMES = [*BASE, *RATIOS, *SPECIAL, "query_cost_share"]


def measure(
    fact: DataFrame,
    names: str | Sequence[str],
    group_by: Sequence[str] = (),
    filters: Sequence[Column] = (),
) -> DataFrame:
    """Compute measures of one fact, one row per group."""
    wanted = [names] if isinstance(names, str) else list(names)
    by = list(group_by)
    for test in filters:
        fact = fact.filter(test)
    need: list[str] = []
    for name in wanted:
        parts = RATIOS[name][:2] if name in RATIOS else (name,) if name in BASE else ()
        need += [p for p in parts if p not in need]
    out = None
    if need:
        out = fact.groupBy(*by).agg(*[BASE[n][1]().alias(n) for n in need])
        out = _with_ratios(out, wanted)
    for name in wanted:
        if name in SPECIAL:
            extra = _peak_daily(fact, by) if name == "peak_daily_cost" else _p90(fact, by)
            out = extra if out is None else _same_groups(out, extra, by)
    return out.select(*by, *wanted)


# Distinct counts of surrogates that are looked up by a join: name -> column.
LOOKED_UP = {"active_identities": "identity_id", "active_resources": "resource_id"}


def measure_apart(
    fact_of: Callable[[Sequence[str]], DataFrame], columns: Sequence[str], names: Sequence[str], group_by: Sequence[str],
) -> DataFrame:
    """``measure`` of a fact that ``fact_of`` gives with the columns it is asked for, all rows each time.

    Distinct counts of looked-up surrogates read a fact of that surrogate alone, and the other measures one of ``columns``
    without them, so the join for a surrogate carries nothing else and lines are not repeated per distinct count.
    """
    by = list(group_by)
    need = list(dict.fromkeys(p for n in names for p in (RATIOS[n][:2] if n in RATIOS else (n,))))
    out = measure(fact_of(columns), [n for n in need if n not in LOOKED_UP], by)
    for name in need:
        if name in LOOKED_UP:
            out = _same_groups(out, measure(fact_of([*by, LOOKED_UP[name]]), name, by), by)
    return _with_ratios(out, names).select(*by, *names)


def _with_ratios(out: DataFrame, names: Sequence[str]) -> DataFrame:
    formulas = {
        n: F.try_divide(ratio(F.col(RATIOS[n][0]), F.col(RATIOS[n][1])), F.lit(float(RATIOS[n][2])))
        for n in names if n in RATIOS
    }
    return out.withColumns(formulas) if formulas else out


def _same_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two per-group results; a NULL group is a group like any other."""
    if not by:
        extra = [c for c in right.columns]
        return left.withColumns({c: right.select(c).scalar() for c in extra})
    side = right.withColumnsRenamed({c: f"__{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(side, same, "left").drop(*[f"__{c}" for c in by])


def _peak_daily(cost: DataFrame, by: Sequence[str]) -> DataFrame:
    daily = cost.groupBy(*by, "usage_dt").agg(F.sum("line_cost_usd").alias("__day"))
    return daily.groupBy(*by).agg(F.max("__day").alias("peak_daily_cost"))


def _p90(queries: DataFrame, by: Sequence[str]) -> DataFrame:
    ms = percentile_inc(queries, "total_duration_ms_nb", 0.9, by, "__ms")
    return ms.select(*by, (F.col("__ms") / 1000).alias("p90_query_duration_s"))


def query_cost_share(cost: DataFrame, queries: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Attributed query cost over all cost. Each fact is reduced before they meet."""
    by = list(group_by)
    all_cost = measure(cost, "total_cost", by)
    joined = _same_groups(all_cost, measure(queries, "total_query_cost", by), by)
    return joined.select(
        *by, "total_cost", "total_query_cost",
        ratio(F.col("total_query_cost"), F.col("total_cost")).alias("query_cost_share"),
    )


def star(
    fact: DataFrame, *dims: tuple[DataFrame, str, Mapping[str, str]], owners: DataFrame | None = None
) -> DataFrame:
    """Add dimension columns to a fact: ``(dimension, key, {column: new name})``. Every key
    is unique in its dimension, so rows are neither lost nor repeated."""
    out = fact
    for dim, key, columns in dims:
        side = dim.select(F.col(key).alias("__key"), *[F.col(c).alias(n) for c, n in columns.items()])
        out = out.join(side, out[key] == side["__key"], "left").drop("__key")
    if owners is not None:
        named = owners.groupBy(F.col("identity_cd").alias("__owner")).agg(
            F.min("display_name_lb").alias("owner_name_lb")
        )
        out = out.join(named, out["owned_by_cd"] == named["__owner"], "left").drop("__owner")
    return out


def ranked(fact: DataFrame, value: str, by: Sequence[str], dense: bool = True,
           filters: Sequence[Column] = ()) -> DataFrame:
    """Every group with its rank by ``value``. Groups are display names, so entities that
    share a name are one. The groups are kept in the checkpoint folder: ranking reads them more than once."""
    ensure_checkpoint_dir(fact.sparkSession)
    return global_rank(measure(fact, value, by, filters).checkpoint(), value, dense)


def top(fact: DataFrame, value: str, by: Sequence[str], n: int = 10, dense: bool = True,
        filters: Sequence[Column] = ()) -> DataFrame:
    """Groups ranked ``n`` or better; ties at the edge stay, so there may be more than ``n``. The groups are kept
    in the checkpoint folder: the best values and the rows that hold them are read from there."""
    ensure_checkpoint_dir(fact.sparkSession)
    return top_n(measure(fact, value, by, filters).checkpoint(), value, n, dense)


def is_job(column: str = "resource_type_lb") -> Column:
    return F.upper(column) == "JOB"


def cost_share(fact: DataFrame, by: Sequence[str], within: Sequence[str] = (),
               usage: bool = False, filters: Sequence[Column] = ()) -> DataFrame:
    """Share of each group in the total of ``within`` (default: of everything selected);
    ``usage`` switches from cost to DBUs."""
    value = "total_usage_dbu" if usage else "total_cost"
    ensure_checkpoint_dir(fact.sparkSession)
    return share(measure(fact, value, [*within, *by], filters).checkpoint(), value, within, "share_pct")

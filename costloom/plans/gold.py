"""Reporting views: dimensions with readable labels, facts with resolved surrogates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import rules
from ..functions.labels import blank_to, environment, environment_order, gigabytes, type_label, yes_no
from ..operators.keys import repeated_keys, resolve_fk
from ..operators.tags import tag_bridge

AUDIT = ["sys_create_dt", "sys_update_dt"]


def _pick(df: DataFrame, *columns) -> DataFrame:
    """Select, leaving out audit columns a caller's table does not have."""
    have = set(df.columns)
    return df.select(*[c for c in columns if not (isinstance(c, str) and c in AUDIT and c not in have)])


def resource_dim(resources: DataFrame) -> DataFrame:
    return _pick(
        resources, "resource_id", F.initcap("resource_type_lb").alias("resource_type_lb"), "source_cd",
        "account_cd", "workspace_cd", "display_name_lb", "owned_by_cd",
        yes_no("is_active_fl").alias("is_active_fl"), *AUDIT,
    )


def identity_dim(identities: DataFrame) -> DataFrame:
    return _pick(
        identities, "identity_id", "account_cd", F.initcap("identity_type_lb").alias("identity_type_lb"),
        "source_cd", "display_name_lb", "identity_cd", "first_name_lb", "last_name_lb",
        yes_no("is_active_fl").alias("is_active_fl"), *AUDIT,
    )


def workspace_dim(workspaces: DataFrame) -> DataFrame:
    extra = [c for c in ("workspace_url_lb", "create_dt", "status_lb") if c in workspaces.columns]
    return _pick(
        workspaces, "workspace_id", "account_cd", "workspace_cd", "workspace_lb",
        environment("workspace_lb").alias("environment_lb"),
        environment_order("workspace_lb").alias("environment_order_nb"),
        *extra, yes_no("is_deleted_fl").alias("is_deleted_fl"), *AUDIT,
    )


def tag_key_dim(keys: DataFrame) -> DataFrame:
    return _pick(keys, "tag_key_id", F.initcap("tag_key_cd").alias("tag_key_cd"), *AUDIT)


def serving_entity_dim(entities: DataFrame) -> DataFrame:
    """The four raw model configurations stay behind."""
    load = [c for c in ("sys_load_dt",) if c in entities.columns]
    return entities.select(
        "entity_id", "account_cd", "workspace_cd", "served_entity_cd", "region_lb", "endpoint_cd",
        "endpoint_name_lb", "served_entity_name_lb", F.initcap("entity_type_lb").alias("entity_type_lb"),
        "entity_name_lb", "entity_version_lb", "endpoint_config_version_nb", "task_lb",
        "created_by_cd", "change_time", yes_no("is_deleted_fl").alias("is_deleted_fl"), *load,
    )


def group_dim(groups: DataFrame) -> DataFrame:
    return _pick(
        groups, "group_id", "account_cd", "group_cd", "display_name_lb",
        yes_no("is_active_fl").alias("is_active_fl"), *AUDIT,
    )


def resource_tag_bridge(bridge: DataFrame) -> DataFrame:
    real = bridge.filter((F.col("resource_id") > 0) & (F.col("tag_key_id") > 0))
    return _pick(real, "resource_id", "tag_key_id", "tag_value_lb", *AUDIT)


def resource_tag_grid(carried: DataFrame, resources: DataFrame, keys: DataFrame) -> DataFrame:
    """Every resource with every tag key, from the tags that are carried; where none is, the audit times are missing."""
    grid = tag_bridge(resources, keys, carried)
    stamps = carried.select("resource_id", "tag_key_id", *AUDIT)
    return grid.join(stamps, ["resource_id", "tag_key_id"], "left").select("resource_id", "tag_key_id", "tag_value_lb", *AUDIT)


def group_member_bridge(edges: DataFrame) -> DataFrame:
    """Ended memberships are shown as such, not hidden."""
    return _pick(
        edges, "account_cd", "group_cd", "member_cd", "member_type_lb",
        yes_no("is_deleted_fl").alias("is_deleted_fl"), *AUDIT,
    )


def visibility_bridge(pairs: DataFrame) -> DataFrame:
    return _pick(pairs, "user_cd", "member_cd", *AUDIT)


def visibility_pairs(people: DataFrame, edges: DataFrame, closed: DataFrame, scope=("account_cd",)) -> DataFrame:
    """``visibility_bridge`` from its factors, when it is read: a filter on ``user_cd`` reaches the memberships before they meet
    the members. A pair is as old as the oldest membership, or user, that makes it."""
    scope = list(scope)
    live = edges.filter((F.col("is_deleted_fl") == 0) & (F.col("member_type_lb") == "Users"))
    own = live.select(*scope, "group_cd", F.col("member_cd").alias("user_cd"), *AUDIT)
    shared = own.join(closed, [*scope, "group_cd"]).select("user_cd", "member_cd", *AUDIT)
    self_rows = people.filter(F.col("user_id") > 0).select("user_cd", F.col("user_cd").alias("member_cd"), *AUDIT)
    pairs = shared.unionByName(self_rows).groupBy("user_cd", "member_cd").agg(
        F.min("sys_create_dt").alias("sys_create_dt"), F.max("sys_update_dt").alias("sys_update_dt"))
    return visibility_bridge(pairs)


def _resolve_workspace(fact: DataFrame, workspaces: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return resolve_fk(
        fact, workspaces, ["account_cd", "workspace_cd"], "workspace_id", rules.UNKNOWN_WORKSPACE,
        carry=carry, sentinels=[rules.UNKNOWN_WORKSPACE],
    )


def _resolve_identity(fact: DataFrame, identities: DataFrame, login: str, carry: Sequence[str] = ()) -> DataFrame:
    """A login may belong to several identities: the active one wins, then the oldest."""
    return resolve_fk(
        fact, identities, {"account_cd": "account_cd", "identity_cd": login}, "identity_id",
        rules.unknown_identity(login), prefer=["is_active_fl"], carry=carry, sentinels=rules.UNKNOWN_IDENTITIES,
    )


def _resolve_resource(fact: DataFrame, resources: DataFrame, kind, source, fallback, carry: Sequence[str] = ()) -> DataFrame:
    return resolve_fk(
        fact,
        resources.withColumn("resource_type_lb", type_label("resource_type_lb")),
        {"account_cd": "account_cd", "workspace_cd": "workspace_cd", "resource_type_lb": kind,
         "source_cd": source},
        "resource_id",
        fallback,
        carry=carry,
        sentinels=[*rules.UNKNOWN_RESOURCE.values(), rules.UNDEFINED_RESOURCE],
    )


# Metadata fields shown as columns of the billing fact.
FLAT_METADATA = {
    "job_cd": "job_id",
    "cluster_cd": "cluster_id",
    "warehouse_cd": "warehouse_id",
    "pipeline_cd": "dlt_pipeline_id",
    "app_cd": "app_id",
    "notebook_cd": "notebook_id",
    "endpoint_cd": "endpoint_id",
    "network_client_cd": "networking_client",
    "dqm_cd": "schema_id",
    "node_type_lb": "node_type",
}


FLAGS = ("is_serverless_fl", "is_photon_fl")
LINE_COLUMNS = ("record_type_lb", "product_lb", "usage_type_lb", "sku_name_lb", "usage_unit_lb", "usage_quantity_nb", "line_cost_usd", *FLAGS,
                "jobs_tier_lb", *FLAT_METADATA, "run_as_cd")
SURROGATES = ("workspace_id", "resource_id", "identity_id")


def billing_cost_fact(
    cost: DataFrame, workspaces: DataFrame, resources: DataFrame, identities: DataFrame,
    compat: bool = False, surrogates: Sequence[str] = SURROGATES, carry: Mapping[str, Sequence[str]] | None = None,
    shown: Sequence[str] | None = None,
) -> DataFrame:
    """One row per billing record: flat metadata, the charged identity and three
    surrogates. ``compat`` keeps two older naming mismatches (see `functions.rules`).

    Only the columns the view shows travel through the joins. ``surrogates`` that are not asked for are left out with their joins: they
    neither add nor drop a row. ``carry`` names dimension columns that come along with a surrogate (see `resolve_fk`).

    What can be told from other columns does not travel: flags are spelled out last, and the charged resource is told from the codes
    where it is looked up. ``shown`` says which columns the caller reads (default: all); where these are not
    all the codes, type and source of the resource travel in their place.
    """
    # Shuffled blocks are smaller where columns that the lines of an order share come first and texts of many lengths last.
    flat = cost.select(
        "account_cd", "workspace_cd", rules.charged_identity().alias("run_as_cd"), "record_cd", "ingestion_dt", "usage_dt",
        "usage_quantity_nb", *FLAGS, "line_cost_usd", "usage_unit_lb", "sku_name_lb",
        *[F.col(f"usage_metadata.{f}").alias(c) for c, f in FLAT_METADATA.items()],
        "jobs_tier_lb", "record_type_lb", "usage_type_lb", "product_lb",
    )
    column_of = {f: c for c, f in FLAT_METADATA.items()}
    code = lambda field: F.col(column_of[field])
    kind, source = rules.resource_type(compat, code), rules.resource_source(compat, code)
    if shown is not None and not {column_of[f] for _, f in rules.RESOURCE_FIELDS} <= {*shown}:
        flat = flat.withColumns({"__type": kind, "__source": source})
        kind, source = F.col("__type"), F.col("__source")
    carry, out = carry or {}, flat
    # Lines of one order have one login and lie together, so they are shuffled first by it; the few workspaces come last.
    if "identity_id" in surrogates:
        out = _resolve_identity(out, identities, "run_as_cd", carry.get("identity_id", ()))
    if "resource_id" not in surrogates:
        pass
    elif compat:
        out = resolve_fk(
            out, resources,
            {"account_cd": "account_cd", "workspace_cd": "workspace_cd", "resource_type_lb": kind, "source_cd": source},
            "resource_id", rules.unknown_resource(kind),
        )
    else:
        out = _resolve_resource(out, resources, kind, source, rules.unknown_resource(kind), carry.get("resource_id", ()))
    if "workspace_id" in surrogates:
        out = _resolve_workspace(out, workspaces, carry.get("workspace_id", ()))
    ids = [c for c in SURROGATES if c in surrogates]
    first = ["record_cd", "ingestion_dt", "usage_dt", "account_cd", *ids[:1] * ("workspace_id" in ids)]
    rest = [yes_no(c).alias(c) if c in FLAGS else c for c in LINE_COLUMNS]
    return out.select(*first, *rest, *[c for c in ids if c not in first], *[c for k in ids for c in carry.get(k, ())])


# Names that reports group by: surrogate -> {shown name: dimension column}.
STAR = {
    "workspace_id": {"workspace_lb": "workspace_lb"},
    "resource_id": {"resource_type_lb": "resource_type_lb", "resource_lb": "display_name_lb", "owned_by_cd": "owned_by_cd",
                    "is_active_fl": "is_active_fl"},
    "identity_id": {"identity_type_lb": "identity_type_lb", "identity_lb": "display_name_lb"},
}


def billing_cost_star(
    cost: DataFrame, workspaces: DataFrame, resources: DataFrame, identities: DataFrame, columns: Sequence[str],
    unique: Sequence[str] = (),
) -> DataFrame:
    """``columns`` of the billing fact and of the names in its dimensions.

    A dimension is joined once: its names come along when its surrogate is looked up, so no fact is shuffled by a surrogate
    that many lines share as fallback. A dimension of which nothing is asked is not joined at all. Either
    holds where surrogates are unique, which one aggregate per dimension tells; where one repeats, a line is repeated as by ``star``.
    Surrogates that the caller knows to be ``unique`` are not counted: a dimension of which nothing else is asked is then not read.
    """
    dims = {"workspace_id": workspaces, "resource_id": resources, "identity_id": identities}
    shown = {"workspace_id": dims["workspace_id"], "resource_id": resource_dim(resources), "identity_id": dims["identity_id"]}
    names = {k: {n: c for n, c in STAR[k].items() if n in columns} for k in dims}
    repeated = {k for k, dim in dims.items() if k not in unique and repeated_keys(dim, k)}
    keyed = [k for k in SURROGATES if k in columns or names[k] or k in repeated]
    carry = {k: [f"__name_{n}" for n in names[k]] for k in keyed if names[k] and k not in repeated}
    views = {"resource_type_lb": F.initcap("resource_type_lb"), "is_active_fl": yes_no("is_active_fl")}
    for k in carry:
        value = lambda c: views[c] if k == "resource_id" and c in views else F.col(c)  # noqa: B023, E731
        dims[k] = dims[k].withColumns({f"__name_{n}": value(c) for n, c in names[k].items()})
    fact = billing_cost_fact(cost, *dims.values(), surrogates=keyed, carry=carry, shown=columns)
    for k in keyed:
        if k in repeated:
            side = shown[k].select(F.col(k).alias("__key"), *[F.col(c).alias(f"__name_{n}") for n, c in names[k].items()])
            fact = fact.join(side, fact[k] == side["__key"], "left").drop("__key")
    named = {n for k in keyed for n in names[k]}
    return fact.select(*[F.col(f"__name_{c}").alias(c) if c in named else F.col(c) for c in columns])


def query_cost_fact(
    attributed: DataFrame, workspaces: DataFrame, resources: DataFrame, identities: DataFrame
) -> DataFrame:
    out = _resolve_workspace(attributed, workspaces)
    out = _resolve_resource(
        out, resources, F.lit("WAREHOUSE"), "warehouse_cd", rules.UNKNOWN_RESOURCE["WAREHOUSE"]
    )
    out = _resolve_identity(out, identities, "executed_by_lb")
    return out.select(
        "statement_cd", "usage_dt", "account_cd", "workspace_id", "resource_id", "identity_id",
        "warehouse_cd", "executed_by_lb", "statement_type_lb", "execution_status_lb",
        blank_to("client_application_lb", "undefined").alias("client_application_lb"),
        "client_driver_lb", yes_no("from_result_cache_fl").alias("from_result_cache_fl"),
        "start_dt", "end_dt", "total_duration_ms_nb", "waiting_for_compute_ms_nb",
        "waiting_at_capacity_ms_nb", "compilation_duration_ms_nb", "execution_duration_ms_nb",
        "billable_duration_ms_nb", "read_rows_nb", "produced_rows_nb",
        gigabytes("read_bytes_nb").alias("read_gb_nb"), "written_rows_nb",
        gigabytes("written_bytes_nb").alias("written_gb_nb"),
        "dashboard_cd", "notebook_cd", "job_cd", "genie_space_cd",
        "warehouse_cost_usd", "total_billable_ms_nb", "attributed_cost_usd",
    )


def serving_cost_fact(
    attributed: DataFrame, workspaces: DataFrame, resources: DataFrame, identities: DataFrame,
    entities: DataFrame,
) -> DataFrame:
    out = _resolve_workspace(attributed, workspaces)
    out = _resolve_resource(
        out, resources, F.lit("ENDPOINT"), "endpoint_cd", rules.UNKNOWN_RESOURCE["ENDPOINT"]
    )
    out = _resolve_identity(out, identities, "requester_lb")
    out = resolve_fk(
        out, entities, ["account_cd", "workspace_cd", "served_entity_cd"], "entity_id",
        rules.UNKNOWN_ENTITY,
    )
    return out.select(
        "databricks_request_cd", "client_request_cd", "usage_dt", "account_cd", "workspace_id",
        "resource_id", "identity_id", "entity_id", "served_entity_cd", "region_lb", "endpoint_cd",
        "endpoint_name_lb", "entity_type_lb", "entity_name_lb", "requester_lb", "status_code_nb",
        "request_dt", "input_token_count_nb", "output_token_count_nb", "input_character_count_nb",
        "output_character_count_nb", yes_no("request_streaming_fl").alias("request_streaming_fl"),
        "total_token_count_nb", "endpoint_cost_usd", "daily_total_token_count_nb",
        "daily_total_request_count_nb", "attributed_cost_usd",
    )

"""Landed tables to silver columns, and the entities billing alone knows about."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import flag, map_or_json, with_nested_text
from ..operators.allocation import statement_weight
from ..operators.compare import any_null, row_hash
from ..operators.latest import latest
from ..schemas import dimension_sentinels

LOAD = "sys_load_dt"


@dataclass(frozen=True)
class Source:
    """How one landed table maps to silver.

    ``rename`` is ordered ``landed -> silver``; a landed name listed in ``maps``
    becomes a string map, one in ``flags`` a 0/1 flag, ``deleted`` names the delete
    timestamp that also yields ``is_deleted_fl``.
    """

    table: str
    keys: tuple[str, ...]
    seq: str
    rename: dict[str, str]
    maps: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    deleted: str | None = None
    id_col: str | None = None
    sentinels: list[dict] = field(default_factory=list)


_PLACE = {"account_id": "account_cd", "region": "region_lb", "workspace_id": "workspace_cd"}

JOBS = Source(
    table="lakeflow_jobs",
    keys=("account_cd", "workspace_cd", "job_cd"),
    seq="change_time",
    rename={
        **_PLACE,
        "job_id": "job_cd",
        "name": "job_name_lb",
        "description": "description_lb",
        "creator_user_name": "creator_userid_cd",
        "create_time": "create_dt",
        "run_as": "run_as_cd",
        "run_as_user_name": "run_as_user_lb",
        "tags": "tags",
        "change_time": "change_time",
        "delete_time": "delete_dt",
    },
    maps=("tags",),
    deleted="delete_time",
    id_col="job_id",
    sentinels=dimension_sentinels(
        "job_id",
        ["account_cd", "workspace_cd", "job_cd", "creator_userid_cd", "run_as_cd"],
        ["job_name_lb", "description_lb", "run_as_user_lb"],
        is_deleted_fl=0,
    ),
)
PIPELINES = Source(
    table="lakeflow_pipelines",
    keys=("account_cd", "workspace_cd", "pipeline_cd"),
    seq="change_time",
    rename={
        **_PLACE,
        "pipeline_id": "pipeline_cd",
        "pipeline_type": "pipeline_type_lb",
        "name": "pipeline_name_lb",
        "created_by": "created_by_cd",
        "create_time": "create_dt",
        "run_as": "run_as_cd",
        "tags": "tags",
        "configuration": "configuration",
        "change_time": "change_time",
        "delete_time": "delete_dt",
    },
    maps=("tags", "configuration"),
    deleted="delete_time",
    id_col="pipeline_id",
    sentinels=dimension_sentinels(
        "pipeline_id",
        ["account_cd", "workspace_cd", "pipeline_cd", "pipeline_type_lb", "created_by_cd", "run_as_cd"],
        ["pipeline_name_lb"],
        is_deleted_fl=0,
    ),
)
CLUSTERS = Source(
    table="compute_clusters",
    keys=("account_cd", "workspace_cd", "cluster_cd"),
    seq="change_time",
    rename={
        **_PLACE,
        "cluster_id": "cluster_cd",
        "cluster_name": "cluster_name_lb",
        "owned_by": "owned_by_cd",
        "create_time": "create_dt",
        "cluster_source": "cluster_source_lb",
        "dbr_version": "dbr_version_lb",
        "driver_node_type": "driver_node_type_lb",
        "worker_node_type": "worker_node_type_lb",
        "worker_count": "worker_count_nb",
        "min_autoscale_workers": "min_autoscale_workers_nb",
        "max_autoscale_workers": "max_autoscale_workers_nb",
        "auto_termination_minutes": "auto_termination_minutes_nb",
        "enable_elastic_disk": "enable_elastic_disk_fl",
        "driver_instance_pool_id": "driver_instance_pool_cd",
        "worker_instance_pool_id": "worker_instance_pool_cd",
        "data_security_mode": "data_security_mode_lb",
        "policy_id": "policy_cd",
        "tags": "tags",
        "change_time": "change_time",
        "delete_time": "delete_dt",
    },
    maps=("tags",),
    flags=("enable_elastic_disk",),
    deleted="delete_time",
    id_col="cluster_id",
    sentinels=dimension_sentinels(
        "cluster_id",
        ["account_cd", "workspace_cd", "cluster_cd", "owned_by_cd", "cluster_source_lb",
         "data_security_mode_lb", "policy_cd"],
        ["cluster_name_lb", "dbr_version_lb", "driver_node_type_lb", "worker_node_type_lb"],
        is_deleted_fl=0,
        enable_elastic_disk_fl=0,
    ),
)
WAREHOUSES = Source(
    table="compute_warehouses",
    keys=("account_cd", "workspace_cd", "warehouse_cd"),
    seq="change_time",
    rename={
        **_PLACE,
        "warehouse_id": "warehouse_cd",
        "warehouse_name": "warehouse_name_lb",
        "warehouse_type": "warehouse_type_lb",
        "warehouse_channel": "warehouse_channel_lb",
        "warehouse_size": "warehouse_size_lb",
        "min_clusters": "min_clusters_nb",
        "max_clusters": "max_clusters_nb",
        "auto_stop_minutes": "auto_stop_minutes_nb",
        "tags": "tags",
        "change_time": "change_time",
        "created_by": "created_by_cd",
        "delete_time": "delete_dt",
    },
    maps=("tags",),
    deleted="delete_time",
    id_col="warehouse_id",
    sentinels=dimension_sentinels(
        "warehouse_id",
        ["account_cd", "workspace_cd", "warehouse_cd", "warehouse_type_lb", "warehouse_channel_lb",
         "warehouse_size_lb"],
        ["warehouse_name_lb"],
        is_deleted_fl=0,
    ),
)
# Statement and error text are left out on purpose: they may hold personal data.
QUERY_HISTORY = Source(
    table="query_history",
    keys=("account_cd", "workspace_cd", "statement_cd"),
    seq="update_time",
    rename={
        "statement_id": "statement_cd",
        "account_id": "account_cd",
        "workspace_id": "workspace_cd",
        "execution_status": "execution_status_lb",
        "statement_type": "statement_type_lb",
        "executed_by": "executed_by_lb",
        "executed_by_user_id": "executed_by_cd",
        "executed_as": "executed_as_lb",
        "executed_as_user_id": "executed_as_cd",
        "compute": "compute",
        "query_source": "query_source",
        "query_tags": "query_tags",
        "client_application": "client_application_lb",
        "client_driver": "client_driver_lb",
        "start_time": "start_dt",
        "end_time": "end_dt",
        "total_duration_ms": "total_duration_ms_nb",
        "execution_duration_ms": "execution_duration_ms_nb",
        "compilation_duration_ms": "compilation_duration_ms_nb",
        "waiting_for_compute_duration_ms": "waiting_for_compute_ms_nb",
        "waiting_at_capacity_duration_ms": "waiting_at_capacity_ms_nb",
        "read_rows": "read_rows_nb",
        "produced_rows": "produced_rows_nb",
        "read_bytes": "read_bytes_nb",
        "written_rows": "written_rows_nb",
        "written_bytes": "written_bytes_nb",
        "from_result_cache": "from_result_cache_fl",
        "update_time": "update_time",
    },
    flags=("from_result_cache",),
)
SERVING_USAGE = Source(
    table="serving_endpoint_usage",
    keys=(),
    seq="request_dt",
    rename={
        **_PLACE,
        "databricks_request_id": "databricks_request_cd",
        "client_request_id": "client_request_cd",
        "served_entity_id": "served_entity_cd",
        "requester": "requester_lb",
        "status_code": "status_code_nb",
        "request_time": "request_dt",
        "input_token_count": "input_token_count_nb",
        "output_token_count": "output_token_count_nb",
        "input_character_count": "input_character_count_nb",
        "output_character_count": "output_character_count_nb",
        "usage_context": "usage_context_lb",
        "request_streaming": "request_streaming_fl",
    },
    flags=("request_streaming",),
)
SERVED_ENTITIES = Source(
    table="serving_served_entities",
    keys=("account_cd", "workspace_cd", "served_entity_cd"),
    seq="change_time",
    rename={
        **_PLACE,
        "served_entity_id": "served_entity_cd",
        "endpoint_id": "endpoint_cd",
        "endpoint_name": "endpoint_name_lb",
        "served_entity_name": "served_entity_name_lb",
        "entity_type": "entity_type_lb",
        "entity_name": "entity_name_lb",
        "entity_version": "entity_version_lb",
        "endpoint_config_version": "endpoint_config_version_nb",
        "task": "task_lb",
        "created_by": "created_by_cd",
        "external_model_config": "external_model_config_lb",
        "foundation_model_config": "foundation_model_config_lb",
        "custom_model_config": "custom_model_config_lb",
        "feature_spec_config": "feature_spec_config_lb",
        "change_time": "change_time",
        "endpoint_delete_time": "endpoint_delete_dt",
    },
    deleted="endpoint_delete_time",
    id_col="entity_id",
    sentinels=dimension_sentinels(
        "entity_id",
        ["account_cd", "workspace_cd", "served_entity_cd", "endpoint_cd", "entity_type_lb"],
        ["endpoint_name_lb", "served_entity_name_lb"],
        endpoint_config_version_nb=0,
        is_deleted_fl=0,
    ),
)
CHANGE_FED = (JOBS, PIPELINES, CLUSTERS, WAREHOUSES, SERVED_ENTITIES)


def _carried(landed: DataFrame, extra: Sequence[str], taken: Iterable[str]) -> list:
    """Landed fields that no rule renames, under their own name, or with ``_landed`` behind it where that is taken."""
    taken = {c.lower() for c in taken}
    return [F.col(f"`{c}`").alias(f"{c}_landed" if c.lower() in taken else c) for c in extra]


def source_view(landed: DataFrame, spec: Source, extra: Sequence[str] = ()) -> DataFrame:
    """Silver columns of one landed table; deletes become a flag, never a missing row. ``extra`` fields are carried along."""
    columns = []
    for raw, name in spec.rename.items():
        value = F.col(raw)
        if raw in spec.maps:
            value = map_or_json(landed, raw)
        elif raw in spec.flags:
            value = flag(F.col(raw))
        columns.append(value.alias(name))
    if spec.deleted:
        columns.append(flag(F.col(spec.deleted).isNotNull()).alias("is_deleted_fl"))
    taken = [*spec.rename.values(), "is_deleted_fl", LOAD, *([spec.id_col] if spec.id_col else [])]
    return landed.select(*columns, F.current_timestamp().alias(LOAD), *_carried(landed, extra, taken))


def usage_fact(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Billing lines: the four identities stay apart and the metadata stays a struct. ``extra`` fields are carried along."""
    renamed = {
        "record_id": "record_cd",
        "account_id": "account_cd",
        "workspace_id": "workspace_cd",
        "record_type": "record_type_lb",
        "ingestion_date": "ingestion_dt",
        "usage_date": "usage_dt",
        "usage_start_time": "usage_start_dt",
        "usage_end_time": "usage_end_dt",
        "billing_origin_product": "product_lb",
        "usage_type": "usage_type_lb",
        "sku_name": "sku_name_lb",
        "cloud": "cloud_lb",
        "usage_unit": "usage_unit_lb",
        "usage_quantity": "usage_quantity_nb",
        "custom_tags": "custom_tags",
        "usage_metadata": "usage_metadata",
        "identity_metadata.run_as": "run_as_cd",
        "identity_metadata.run_by": "run_by_cd",
        "identity_metadata.created_by": "created_by_cd",
        "identity_metadata.owned_by": "owned_by_cd",
        "product_features.jobs_tier": "jobs_tier_lb",
    }
    flags = {f"{f}_fl": flag(F.col(f"product_features.{f}")) for f in ("is_serverless", "is_photon")}
    return landed.select(
        *[F.col(raw).alias(name) for raw, name in renamed.items()],
        *[value.alias(name) for name, value in flags.items()],
        F.current_timestamp().alias(LOAD),
        *_carried(landed, extra, [*renamed.values(), *flags, LOAD, LINE, "line_cost_usd", "usage_load_dt"]),
    )


# Row expectations: broken rows are counted, never dropped.
USAGE_RULES = {
    "record_id not null": "record_cd is not null",
    "account_cd not null": "account_cd is not null",
    "ingestion_dt not null": "ingestion_dt is not null",
}
SERVING_RULES = {
    "databricks_request_cd not null": "databricks_request_cd is not null",
    "account_cd not null": "account_cd is not null",
    "request_dt not null": "request_dt is not null",
}


LINE_KEYS = ("account_cd", "workspace_cd", "record_cd", "ingestion_dt")
LINE = "line_cd"


def dedupe_usage(usage: DataFrame, load: str = LOAD, origin: str = LOAD) -> DataFrame:
    """The latest load of every billing line, with the line's identity in ``line_cd``.

    A line is known by account, workspace, record and ingestion day. Where one of these is
    missing nothing can tell whether it was sent before, so the line stays whatever else
    arrived: its identity is its ``origin`` (load time or batch), its content and, for equal lines of
    one origin, a number. Origins are stored with the usage, so a repeated step finds the same
    identities.
    """
    keys = list(LINE_KEYS)
    whole = usage.filter(~any_null(keys))
    content = row_hash(usage, [origin, *(c for c in usage.columns if c not in (load, origin))])
    partial = usage.filter(any_null(keys)).withColumn("__same", content)
    copy = F.row_number().over(Window.partitionBy("__same").orderBy(F.lit(0)))
    named = partial.withColumn(LINE, F.concat_ws("-", F.col("__same").cast("string"), copy.cast("string"))).drop("__same")
    return latest(whole, keys, load).withColumn(LINE, F.lit("")).unionByName(named)


def price_view(landed: DataFrame) -> DataFrame:
    """List prices with typed amounts; text that is not a number becomes NULL."""
    return landed.select(
        F.col("account_id").alias("account_cd"),
        F.col("sku_name").alias("sku_name_lb"),
        F.col("cloud").alias("cloud_lb"),
        F.col("currency_code").alias("currency_code_lb"),
        F.col("usage_unit").alias("usage_unit_lb"),
        F.col("pricing.default").try_cast("double").alias("default_price_nb"),
        F.col("pricing.effective_list.default").try_cast("double").alias("effective_list_price_nb"),
        F.col("price_start_time").alias("price_start_dt"),
        F.col("price_end_time").alias("price_end_dt"),
    )


@dataclass(frozen=True)
class BillingEntity:
    """An entity seen only in billing lines: which lines name it and what they tell."""

    name: str
    code: str
    id_col: str
    metadata_field: str
    label: tuple[str, str] | None = None
    owner: str = "run_as_cd"
    product: str | None = None
    only_product: bool = False
    default_code: str | None = None

    @property
    def keys(self) -> tuple[str, str, str]:
        return ("account_cd", "workspace_cd", self.code)

    @property
    def sentinels(self) -> list[dict]:
        codes = ["account_cd", "workspace_cd", self.code, "product_lb"]
        if self.name in ("app", "data_quality_monitoring"):
            codes.append(self.owner)
        names = [self.label[0]] if self.label else []
        if self.name == "network":
            codes.remove("product_lb")
            names.append("product_lb")
        return dimension_sentinels(self.id_col, codes, names)


APP = BillingEntity("app", "app_cd", "app_id", "app_id", ("app_name_lb", "app_name"))
NOTEBOOK = BillingEntity(
    "notebook", "notebook_cd", "notebook_id", "notebook_id", ("notebook_path_lb", "notebook_path")
)
ENDPOINT = BillingEntity(
    "endpoint", "endpoint_cd", "endpoint_id", "endpoint_id", ("endpoint_name_lb", "endpoint_name")
)
NETWORK = BillingEntity(
    "network", "network_client_cd", "network_id", "networking_client",
    product="NETWORKING", default_code="NETWORKING",
)
MONITOR = BillingEntity(
    "data_quality_monitoring", "dqm_cd", "dqm_id", "schema_id",
    owner="created_by_cd", product="DATA_QUALITY_MONITORING", only_product=True,
)
BILLING_ENTITIES = (APP, NOTEBOOK, ENDPOINT, NETWORK, MONITOR)


def extract_entity(landed: DataFrame, spec: BillingEntity) -> DataFrame:
    """Lines that name the entity, reduced to its attributes. One row per line; the
    caller folds them with ``scd1``. ``usage_end_dt`` and ``record_cd`` ride along to
    order lines of one ingestion day."""
    named = F.col(f"usage_metadata.{spec.metadata_field}")
    of_product = F.col("billing_origin_product") == spec.product if spec.product else F.lit(False)
    chosen = of_product if spec.only_product else named.isNotNull() | of_product
    code = F.coalesce(named, F.lit(spec.default_code)) if spec.default_code else named
    if spec.owner == "created_by_cd":
        owner: Column = F.col("identity_metadata.created_by")
    else:
        owner = F.coalesce(
            *[f"identity_metadata.{f}" for f in ("run_as", "run_by", "created_by", "owned_by")]
        )
    columns = [
        F.col("account_id").alias("account_cd"),
        F.col("workspace_id").alias("workspace_cd"),
        code.alias(spec.code),
        owner.alias(spec.owner),
        F.col("billing_origin_product").alias("product_lb"),
    ]
    if spec.label:
        columns.append(F.col(f"usage_metadata.{spec.label[1]}").alias(spec.label[0]))
    return landed.filter(chosen).select(
        *columns,
        F.col("custom_tags").alias("tags"),
        F.col("ingestion_date").alias("ingestion_dt"),
        F.col("usage_end_time").alias("usage_end_dt"),
        F.col("record_id").alias("record_cd"),
        F.current_timestamp().alias(LOAD),
    )


ENTITY_ORDER = ("usage_end_dt", "record_cd")


def billing_entity(landed: DataFrame, spec: BillingEntity, keep: str = "last") -> DataFrame:
    """One row per entity from a batch of lines: the latest ingestion day (``keep='first'``
    the earliest). Lines without the key are left out."""
    lines = extract_entity(landed, spec)
    return latest(lines.filter(~any_null(spec.keys)), spec.keys, "ingestion_dt", ENTITY_ORDER, keep)


def statements(query_history: DataFrame) -> DataFrame:
    """Statements that ran on a warehouse, with their billable weight and origin."""
    origin = {
        "dashboard_cd": "dashboard_id",
        "notebook_cd": "notebook_id",
        "job_cd": "job_info.job_id",
        "genie_space_cd": "genie_space_id",
    }
    weight = statement_weight("from_result_cache_fl", "total_duration_ms_nb", "waiting_at_capacity_ms_nb")
    on_warehouse = with_nested_text(query_history, "compute", {"warehouse_cd": "warehouse_id"}).filter(
        F.col("warehouse_cd").isNotNull()
    )
    return with_nested_text(on_warehouse, "query_source", origin).withColumns({
        "usage_dt": F.to_date("start_dt"),
        "billable_duration_ms_nb": weight.cast("bigint"),
    })


def serving_requests(serving_usage: DataFrame, entities: DataFrame) -> DataFrame:
    """Serving requests with the endpoint of their served entity. Requests without a
    known endpoint cannot be charged and are left out."""
    on = ["account_cd", "workspace_cd", "served_entity_cd"]
    parents = entities.filter(F.col("endpoint_cd").isNotNull()).select(
        *on, "endpoint_cd", "endpoint_name_lb", "entity_type_lb", "entity_name_lb"
    )
    tokens = F.coalesce("input_token_count_nb", F.lit(0)) + F.coalesce("output_token_count_nb", F.lit(0))
    return (
        serving_usage.join(parents, on)
        .withColumn("usage_dt", F.to_date("request_dt"))
        .withColumn("total_token_count_nb", tokens.cast("bigint"))
    )

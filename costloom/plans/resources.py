"""The unified resource dimension and its tags."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import flag
from ..operators.keys import real_rows, with_new_keys
from ..operators.latest import latest
from ..operators.merge import merge
from ..operators.tags import tagged
from ..session import ensure_checkpoint_dir

RESOURCE_KEYS = ["account_cd", "workspace_cd", "source_cd", "resource_type_lb"]
RESOURCE_GUARD = ["region_lb", "display_name_lb", "owned_by_cd", "is_active_fl"]
RESOURCE_COLUMNS = [
    "resource_type_lb", "source_cd", "account_cd", "region_lb", "workspace_cd",
    "display_name_lb", "owned_by_cd", "is_active_fl",
]


@dataclass(frozen=True)
class Branch:
    """One dimension's contribution. Without ``region`` it is global, without
    ``deletable`` it is always active."""

    kind: str
    table: str
    id_col: str
    source: str
    name: str
    owner: str | None
    region: bool = False
    deletable: bool = False


BRANCHES = (
    Branch("JOB", "td_lakeflow_job", "job_id", "job_cd", "job_name_lb", "creator_userid_cd", True, True),
    Branch("WAREHOUSE", "td_compute_warehouse", "warehouse_id", "warehouse_cd", "warehouse_name_lb",
           "created_by_cd", True, True),
    Branch("PIPELINE", "td_lakeflow_pipeline", "pipeline_id", "pipeline_cd", "pipeline_name_lb",
           "created_by_cd", True, True),
    Branch("CLUSTER", "td_compute_cluster", "cluster_id", "cluster_cd", "cluster_name_lb",
           "owned_by_cd", True, True),
    Branch("APP", "td_billing_app", "app_id", "app_cd", "app_name_lb", "run_as_cd"),
    Branch("NOTEBOOK", "td_billing_notebook", "notebook_id", "notebook_cd", "notebook_path_lb", "run_as_cd"),
    Branch("NETWORKING", "td_billing_network", "network_id", "network_client_cd", "network_client_cd",
           "run_as_cd"),
    Branch("DATA QUALITY MONITORING", "td_billing_data_quality_monitoring", "dqm_id", "dqm_cd", "dqm_cd",
           "created_by_cd"),
)
SERVED = Branch("ENDPOINT", "td_serving_entity", "entity_id", "endpoint_cd", "endpoint_name_lb",
                "created_by_cd", True, True)
BILLED = Branch("ENDPOINT", "td_billing_endpoint", "endpoint_id", "endpoint_cd", "endpoint_name_lb",
                "run_as_cd")

# Type, table, natural key and surrogate of every dimension that carries tags.
TAGGED = (
    ("JOB", "td_lakeflow_job", "job_cd", "job_id"),
    ("WAREHOUSE", "td_compute_warehouse", "warehouse_cd", "warehouse_id"),
    ("PIPELINE", "td_lakeflow_pipeline", "pipeline_cd", "pipeline_id"),
    ("CLUSTER", "td_compute_cluster", "cluster_cd", "cluster_id"),
    ("APP", "td_billing_app", "app_cd", "app_id"),
    ("NOTEBOOK", "td_billing_notebook", "notebook_cd", "notebook_id"),
    ("ENDPOINT", "td_billing_endpoint", "endpoint_cd", "endpoint_id"),
    ("NETWORKING", "td_billing_network", "network_client_cd", "network_id"),
    ("DATA QUALITY MONITORING", "td_billing_data_quality_monitoring", "dqm_cd", "dqm_id"),
)


def branch_rows(dim: DataFrame, spec: Branch) -> DataFrame:
    return real_rows(dim, spec.id_col).select(
        F.lit(spec.kind).alias("resource_type_lb"),
        F.col(spec.source).alias("source_cd"),
        "account_cd",
        (F.col("region_lb") if spec.region else F.lit("global")).alias("region_lb"),
        "workspace_cd",
        F.col(spec.name).alias("display_name_lb"),
        (F.col(spec.owner) if spec.owner else F.lit(None).cast("string")).alias("owned_by_cd"),
        (flag(F.col("is_deleted_fl") == 0) if spec.deletable else F.lit(1)).alias("is_active_fl"),
    )


def served_endpoints(entities: DataFrame) -> DataFrame:
    """Endpoint rows from served entities: the entity changed last speaks for its endpoint."""
    known = real_rows(entities, "entity_id").filter(F.col("endpoint_cd").isNotNull())
    newest = latest(
        known, ["account_cd", "workspace_cd", "endpoint_cd"], "change_time", ["served_entity_cd"]
    )
    return branch_rows(newest, SERVED)


def billed_endpoints(endpoints: DataFrame, entities: DataFrame) -> DataFrame:
    """Endpoint rows seen only in billing."""
    on = ["account_cd", "workspace_cd", "endpoint_cd"]
    served = real_rows(entities, "entity_id").select(*on)
    return branch_rows(endpoints.join(served, on, "left_anti"), BILLED)


def optimizer_rows(workspaces: DataFrame) -> DataFrame:
    """One predictive-optimization resource per workspace."""
    return real_rows(workspaces, "workspace_id").select(
        F.lit("PREDICTIVE OPTIMIZATION").alias("resource_type_lb"),
        F.lit("PREDICTIVE_OPTIMIZATION").alias("source_cd"),
        "account_cd",
        F.lit("global").alias("region_lb"),
        "workspace_cd",
        F.lit("Predictive Optimization").alias("display_name_lb"),
        F.lit("System-User").alias("owned_by_cd"),
        F.lit(1).alias("is_active_fl"),
    )


def unify_resources(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All resources of all dimensions in one shape. Missing tables are skipped."""
    parts = [branch_rows(tables[b.table], b) for b in BRANCHES if b.table in tables]
    if SERVED.table in tables:
        parts.append(served_endpoints(tables[SERVED.table]))
    if BILLED.table in tables:
        if SERVED.table in tables:
            parts.append(billed_endpoints(tables[BILLED.table], tables[SERVED.table]))
        else:
            parts.append(branch_rows(tables[BILLED.table], BILLED))
    if "td_workspace" in tables:
        parts.append(optimizer_rows(tables["td_workspace"]))
    return reduce(DataFrame.unionByName, parts).select(*RESOURCE_COLUMNS)


def unify_resources_earlier(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The former eight-branch form: no served entities, monitors or optimizer; an
    endpoint is typed by its product, and only jobs, pipelines, clusters and apps
    name an owner."""
    owners = {"JOB": "creator_userid_cd", "PIPELINE": "created_by_cd", "CLUSTER": "owned_by_cd",
              "APP": "run_as_cd"}
    parts = []
    for b in [*BRANCHES, BILLED]:
        if b.kind == "DATA QUALITY MONITORING" or b.table not in tables:
            continue
        dim = tables[b.table]
        spec = Branch(b.kind, b.table, b.id_col, b.source, b.name, owners.get(b.kind), False, b.deletable)
        rows = branch_rows(dim, spec)
        if b is BILLED:
            typed = real_rows(dim, b.id_col).select(
                "account_cd", "workspace_cd", F.col("endpoint_cd").alias("source_cd"),
                F.col("product_lb").alias("__type"),
            )
            rows = rows.join(typed, ["account_cd", "workspace_cd", "source_cd"]).withColumn(
                "resource_type_lb", F.col("__type")
            )
        parts.append(rows.select(*RESOURCE_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def merge_resources(resources: DataFrame, unified: DataFrame, actions: bool = False) -> DataFrame:
    """Upsert; surrogates of known resources stay, new ones are numbered after the highest.

    The union of all branches is read several times, so it is written to the checkpoint folder once."""
    ensure_checkpoint_dir(unified.sparkSession)
    unified = unified.checkpoint()
    now = F.current_timestamp()
    return merge(
        resources,
        with_new_keys(unified, resources, RESOURCE_KEYS, "resource_id"),
        RESOURCE_KEYS,
        guard=RESOURCE_GUARD,
        update={**{c: F.col(f"s.{c}") for c in RESOURCE_GUARD}, "sys_update_dt": now},
        insert={"sys_create_dt": now, "sys_update_dt": now},
        actions=actions,
    )


def merge_tag_keys(keys: DataFrame, found: DataFrame, actions: bool = False) -> DataFrame:
    """Insert tag keys not known yet, compared without regard to case."""
    now = F.current_timestamp()
    fold = lambda df: df.withColumn("__u", F.upper("tag_key_cd"))
    known = fold(keys)
    fresh = with_new_keys(fold(found.drop("tag_key_id")), known, ["__u"], "tag_key_id")
    return merge(known, fresh, ["__u"], insert={"sys_create_dt": now, "sys_update_dt": now}, actions=actions).drop("__u")


def merge_bridge(bridge: DataFrame, fresh: DataFrame, actions: bool = False) -> DataFrame:
    """Upsert tag values; a pair that is gone from the grid keeps its last value."""
    now = F.current_timestamp()
    return merge(
        bridge,
        fresh,
        ["resource_id", "tag_key_id"],
        guard=["tag_value_lb"],
        update={"tag_value_lb": F.col("s.tag_value_lb"), "sys_update_dt": now},
        insert={"sys_create_dt": now, "sys_update_dt": now},
        actions=actions,
    )


def tag_maps(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tagged([(k, tables[t], n, i) for k, t, n, i in TAGGED if t in tables])

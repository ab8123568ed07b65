"""Input schemas of the landed tables and the fixed sentinel rows of the dimensions."""

from __future__ import annotations

_USAGE_METADATA = (
    "struct<cluster_id:string,warehouse_id:string,instance_pool_id:string,node_type:string,"
    "job_id:string,job_run_id:string,notebook_id:string,notebook_path:string,"
    "dlt_pipeline_id:string,endpoint_id:string,endpoint_name:string,app_id:string,"
    "app_name:string,networking_client:string,schema_id:string>"
)

# Spark DDL per landed table. Tags and configuration arrive as JSON text or as maps.
LANDED = {
    "lakeflow_jobs": (
        "account_id string, workspace_id string, job_id string, name string, description string, "
        "creator_user_name string, create_time timestamp, run_as string, run_as_user_name string, "
        "tags string, change_time timestamp, delete_time timestamp, region string"
    ),
    "lakeflow_pipelines": (
        "account_id string, workspace_id string, pipeline_id string, pipeline_type string, "
        "name string, created_by string, create_time timestamp, run_as string, tags string, "
        "configuration string, change_time timestamp, delete_time timestamp, region string"
    ),
    "compute_clusters": (
        "account_id string, workspace_id string, cluster_id string, cluster_name string, "
        "owned_by string, create_time timestamp, cluster_source string, dbr_version string, "
        "driver_node_type string, worker_node_type string, worker_count bigint, "
        "min_autoscale_workers bigint, max_autoscale_workers bigint, "
        "auto_termination_minutes bigint, enable_elastic_disk boolean, "
        "driver_instance_pool_id string, worker_instance_pool_id string, "
        "data_security_mode string, policy_id string, tags string, change_time timestamp, "
        "delete_time timestamp, region string"
    ),
    "compute_warehouses": (
        "account_id string, workspace_id string, warehouse_id string, warehouse_name string, "
        "warehouse_type string, warehouse_channel string, warehouse_size string, "
        "min_clusters int, max_clusters int, auto_stop_minutes int, tags string, "
        "change_time timestamp, created_by string, delete_time timestamp, region string"
    ),
    "billing_usage": (
        "account_id string, workspace_id string, record_id string, sku_name string, cloud string, "
        "usage_start_time timestamp, usage_end_time timestamp, usage_date date, "
        "custom_tags map<string,string>, usage_unit string, usage_quantity double, "
        f"usage_metadata {_USAGE_METADATA}, "
        "identity_metadata struct<run_as:string,run_by:string,created_by:string,owned_by:string>, "
        "record_type string, ingestion_date date, billing_origin_product string, "
        "product_features struct<jobs_tier:string,is_serverless:boolean,is_photon:boolean>, "
        "usage_type string"
    ),
    "billing_list_prices": (
        "account_id string, sku_name string, cloud string, currency_code string, "
        "usage_unit string, pricing struct<default:string,promotional:struct<default:string>,"
        "effective_list:struct<default:string>>, price_start_time timestamp, price_end_time timestamp"
    ),
    "access_workspaces": (
        "account_id string, workspace_id string, workspace_name string, workspace_url string, "
        "create_time timestamp, status string"
    ),
    "query_history": (
        "statement_id string, account_id string, workspace_id string, execution_status string, "
        "statement_type string, executed_by string, executed_by_user_id string, "
        "executed_as string, executed_as_user_id string, compute string, query_source string, "
        "query_tags map<string,string>, client_application string, client_driver string, "
        "start_time timestamp, end_time timestamp, total_duration_ms bigint, "
        "execution_duration_ms bigint, compilation_duration_ms bigint, "
        "waiting_for_compute_duration_ms bigint, waiting_at_capacity_duration_ms bigint, "
        "read_rows bigint, produced_rows bigint, read_bytes bigint, written_rows bigint, "
        "written_bytes bigint, from_result_cache boolean, update_time timestamp"
    ),
    "serving_endpoint_usage": (
        "account_id string, workspace_id string, region string, databricks_request_id string, "
        "client_request_id string, served_entity_id string, requester string, status_code int, "
        "request_time timestamp, input_token_count bigint, output_token_count bigint, "
        "input_character_count bigint, output_character_count bigint, usage_context string, "
        "request_streaming boolean"
    ),
    "serving_served_entities": (
        "account_id string, workspace_id string, served_entity_id string, region string, "
        "endpoint_id string, endpoint_name string, served_entity_name string, entity_type string, "
        "entity_name string, entity_version string, endpoint_config_version int, task string, "
        "created_by string, external_model_config string, foundation_model_config string, "
        "custom_model_config string, feature_spec_config string, change_time timestamp, "
        "endpoint_delete_time timestamp"
    ),
    "account_users": (
        "id string, account_id string, active boolean, deleted_at timestamp, "
        "first_seen_at timestamp, last_seen_at timestamp, raw string"
    ),
    "account_service_principals": (
        "id string, account_id string, active boolean, deleted_at timestamp, "
        "first_seen_at timestamp, last_seen_at timestamp, raw string"
    ),
    "account_groups": (
        "id string, account_id string, deleted_at timestamp, first_seen_at timestamp, "
        "last_seen_at timestamp, raw string"
    ),
}


def _rows(columns: str, *values: tuple) -> list[dict]:
    names = columns.split()
    return [dict(zip(names, v, strict=True)) for v in values]


# Placeholder rows, keyed by dimension. Facts that find no dimension
# row point at one of these.
WORKSPACE_SENTINELS = _rows(
    "workspace_id account_cd workspace_cd workspace_lb workspace_url_lb status_lb is_deleted_fl",
    (-4, "Z_DEL", "Z_DEL", "Z_Deleted", "Z_DEL", "Z_DEL", 0),
    (-3, "Z_OTHER", "Z_OTHER", "Z_Other", "Z_OTHER", "Z_OTHER", 0),
    (-2, "Z_UNS", "Z_UNS", "Z_Unassigned", "Z_UNS", "Z_UNS", 0),
    (-1, "Z_UNK", "Z_UNK", "Z_Unknown", "Z_UNK", "Z_UNK", 0),
)
TAG_KEY_SENTINELS = _rows(
    "tag_key_id tag_key_cd raw_key_lb",
    (-2, "Unassigned", "Unassigned"),
    (-1, "Unknown", "Unknown"),
)
USER_SENTINELS = _rows(
    "user_id account_cd user_cd username_lb display_name_lb first_name_lb last_name_lb "
    "is_active_fl external_cd primary_email_lb",
    (-2, "UNS", "UNS", "Unassigned", "Unassigned", "Unassigned", "Unassigned", 0, "UNS", "UNS"),
    (-1, "UNK", "UNK", "Unknown", "Unknown", "Unknown", "Unknown", 0, "UNK", "UNK"),
)
SERVICE_PRINCIPAL_SENTINELS = _rows(
    "sp_id account_cd sp_cd application_cd display_name_lb is_active_fl external_cd",
    (-2, "UNS", "UNS", "UNS", "Unassigned", 0, "UNS"),
    (-1, "UNK", "UNK", "UNK", "Unknown", 0, "UNK"),
)
IDENTITY_SENTINELS = [
    {
        "identity_id": key,
        "account_cd": "Z_OTHER",
        "identity_type_lb": kind,
        "source_cd": source,
        "display_name_lb": name,
        "identity_cd": code,
        "first_name_lb": code,
        "last_name_lb": code,
        "primary_email_lb": code,
        "is_active_fl": 1 if key == 0 else 0,
        "external_cd": code,
    }
    for key, kind, source, name, code in [
        (-6, "Z_OTHER", "Z_DEL", "Deleted Identity", "Z_DEL"),
        (-5, "Z_OTHER", "Z_OTHER", "Other Identity", "Z_OTHER"),
        (-4, "SERVICE PRINCIPAL", "Z_UNKNOWN_SP", "Unknown Service Principal", "Z_UNKNOWN_SP"),
        (-3, "USER", "Z_UNKNOWN_USER", "Unknown User", "Z_UNKNOWN_USER"),
        (-2, "Z_OTHER", "Z_UNS", "Unassigned Identity", "Z_UNS"),
        (-1, "Z_OTHER", "Z_UNK", "Unknown Identity", "Z_UNK"),
        (0, "USER", "System-User", "System User", "Z_SYSTEM_USER"),
    ]
]
GROUP_SENTINELS = _rows(
    "group_id account_cd group_cd display_name_lb is_active_fl",
    (-2, "Z_OTHER", "Z_UNS", "Unassigned Group", 0),
    (-1, "Z_OTHER", "Z_UNK", "Unknown Group", 0),
)
RESOURCE_SENTINELS = [
    {
        "resource_id": key,
        "resource_type_lb": kind,
        "source_cd": source,
        "account_cd": owner,
        "workspace_cd": owner,
        "display_name_lb": name,
        "owned_by_cd": owner,
        "is_active_fl": 0,
    }
    for key, kind, source, owner, name in [
        (-11, "DATA QUALITY MONITORING", "Z_UNKNOWN_DQM", "Z_UNKNOWN", "Unknown Data Quality Monitoring"),
        (-10, "NETWORKING", "Z_UNKNOWN_NETWORKING", "Z_UNKNOWN", "Unknown Networking"),
        (-9, "ENDPOINT", "Z_UNKNOWN_ENDPOINT", "Z_UNKNOWN", "Unknown Endpoint"),
        (-8, "NOTEBOOK", "Z_UNKNOWN_NOTEBOOK", "Z_UNKNOWN", "Unknown Notebook"),
        (-7, "APP", "Z_UNKNOWN_APP", "Z_UNKNOWN", "Unknown App"),
        (-6, "WAREHOUSE", "Z_UNKNOWN_WAREHOUSE", "Z_UNKNOWN", "Unknown Warehouse"),
        (-5, "CLUSTER", "Z_UNKNOWN_CLUSTER", "Z_UNKNOWN", "Unknown Cluster"),
        (-4, "PIPELINE", "Z_UNKNOWN_PIPELINE", "Z_UNKNOWN", "Unknown Pipeline"),
        (-3, "JOB", "Z_UNKNOWN_JOB", "Z_UNKNOWN", "Unknown Job"),
        (-2, "Z_OTHER", "Z_UNDEFINED", "Z_OTHER", "Unassigned Resource"),
        (-1, "Z_OTHER", "Z_UNKNOWN", "Z_OTHER", "Unknown Resource"),
        (0, "Z_OTHER", "Z_OTHER", "Z_OTHER", "Other Resource"),
    ]
]


def dimension_sentinels(id_col: str, code_cols: list[str], name_cols: list[str], **fixed) -> list[dict]:
    """The unassigned/unknown pair of a change-fed dimension (surrogates -2 and -1)."""
    rows = []
    for key, code, name in [(-2, "UNS", "Unassigned"), (-1, "UNK", "Unknown")]:
        row = {id_col: key, **{c: code for c in code_cols}, **{c: name for c in name_cols}, **fixed}
        rows.append(row)
    return rows

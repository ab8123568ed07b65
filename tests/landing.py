"""Hand-made landed rows: small, but with the awkward cases."""

import datetime as dt
import json

from pyspark.sql import types as T

from costloom.schemas import LANDED

D = dt.date(2024, 3, 1)
NOON = dt.datetime(2024, 3, 1, 12)
GUID = "0a1b2c3d-0000-1111-2222-333344445555"


def h(hours):
    return NOON + dt.timedelta(hours=hours)


def frame(spark, table, dicts):
    schema = T.StructType.fromDDL(LANDED[table]) if hasattr(T.StructType, "fromDDL") else None
    if schema is None:
        schema = spark.createDataFrame([], LANDED[table]).schema
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema.fields) for d in dicts], schema)


def land(spark, root, table, dicts, part):
    frame(spark, table, dicts).coalesce(1).write.mode("overwrite").parquet(f"{root}/{table}/{part}")


PLACE = {"account_id": "acct", "workspace_id": "w1"}


def usage(record, **kw):
    meta = {f.name: None for f in _meta_fields()}
    meta.update(kw.pop("meta", {}))
    row = {
        **PLACE, "record_id": record, "sku_name": "SKU", "cloud": "AWS", "usage_start_time": h(0),
        "usage_end_time": h(1), "usage_date": D, "custom_tags": {"app_id": "A1"}, "usage_unit": "DBU",
        "usage_quantity": 2.0, "usage_metadata": tuple(meta.values()),
        "identity_metadata": ("ann@x.org", None, None, None), "record_type": "ORIGINAL",
        "ingestion_date": D, "billing_origin_product": "SQL", "product_features": ("CORE", True, None),
        "usage_type": "COMPUTE_TIME",
    }
    row.update(kw)
    return row


def _meta_fields():
    names = ["cluster_id", "warehouse_id", "instance_pool_id", "node_type", "job_id", "job_run_id", "notebook_id",
             "notebook_path", "dlt_pipeline_id", "endpoint_id", "endpoint_name", "app_id", "app_name",
             "networking_client", "schema_id"]
    return [T.StructField(n, T.StringType()) for n in names]


def price(start, end, default, effective=None, currency="USD"):
    return {"account_id": "acct", "sku_name": "SKU", "cloud": "AWS", "currency_code": currency, "usage_unit": "DBU",
            "pricing": (default, (None,), (effective,)), "price_start_time": start, "price_end_time": end}


def statement(sid, total, queued=0, cached=False, by="ann@x.org", start=0, warehouse="wh1", status="FINISHED", update=0):
    return {**PLACE, "statement_id": sid, "execution_status": status, "statement_type": "SELECT", "executed_by": by,
            "compute": json.dumps({"warehouse_id": warehouse}) if warehouse else None, "start_time": h(start),
            "query_source": json.dumps({"job_info": {"job_id": "j1"}, "dashboard_id": "d1"}),
            "end_time": h(start), "total_duration_ms": total, "waiting_at_capacity_duration_ms": queued,
            "from_result_cache": cached, "update_time": h(update), "read_bytes": 1500000000, "client_application": ""}


def request(rid, entity, tokens, requester="bob@x.org"):
    return {**PLACE, "databricks_request_id": rid, "served_entity_id": entity, "requester": requester, "status_code": 200,
            "request_time": h(2), "input_token_count": tokens, "request_streaming": None, "region": "eu"}


def entity(eid, endpoint, change=0, deleted=None, name="m"):
    return {**PLACE, "served_entity_id": eid, "endpoint_id": endpoint, "endpoint_name": f"name {endpoint}",
            "entity_type": "CUSTOM_MODEL", "served_entity_name": name, "change_time": h(change), "endpoint_delete_time": deleted}


def job(jid, name, change=0, tags='{"team":"x"}', deleted=None):
    return {**PLACE, "job_id": jid, "name": name, "tags": tags, "change_time": h(change), "delete_time": deleted, "region": "eu"}


def warehouse(wid, name, change=0):
    return {**PLACE, "warehouse_id": wid, "warehouse_name": name, "tags": '{"Env":"prod"}', "change_time": h(change), "region": "eu"}


def user(uid, mail, active=True, deleted=None, emails=None):
    raw = {"userName": mail, "displayName": uid.upper(), "name": {"givenName": "G", "familyName": "F"},
           "emails": emails if emails is not None else [{"primary": True, "type": "work", "value": mail}]}
    return {"id": uid, "account_id": "acct", "active": active, "deleted_at": deleted, "first_seen_at": h(0),
            "last_seen_at": h(1), "raw": json.dumps(raw)}


def principal(sid, app):
    return {"id": sid, "account_id": "acct", "active": True, "first_seen_at": h(0), "last_seen_at": h(1),
            "raw": json.dumps({"applicationId": app, "displayName": sid})}


def group(gid, members, deleted=None):
    raw = {"displayName": gid}
    if members is not None:
        raw["members"] = [{"$ref": m, "display": m, "value": m.split("/")[-1]} for m in members]
    return {"id": gid, "account_id": "acct", "deleted_at": deleted, "first_seen_at": h(0), "last_seen_at": h(1),
            "raw": json.dumps(raw)}


def workspace(wid, name, status="RUNNING"):
    return {"account_id": "acct", "workspace_id": wid, "workspace_name": name, "workspace_url": f"https://{name}",
            "create_time": h(0), "status": status}


def first_day(spark, root):
    land(spark, root, "billing_usage", [
        usage("r1", meta={"warehouse_id": "wh1"}),
        usage("r2", meta={"warehouse_id": "wh1"}, usage_quantity=3.0),
        usage("r3", meta={"endpoint_id": "ep1", "endpoint_name": "E"}, billing_origin_product="MODEL_SERVING"),
        usage("r4", meta={"job_id": "j1"}, billing_origin_product="JOBS", identity_metadata=(GUID, None, None, None)),
        usage("r5", meta={"schema_id": "dq1"}, billing_origin_product="DATA_QUALITY_MONITORING",
              identity_metadata=("ann@x.org", None, "bob@x.org", None)),
        usage("r6", billing_origin_product="DATA_QUALITY_MONITORING", identity_metadata=(None, None, None, None)),
        usage("r7", billing_origin_product="NETWORKING", identity_metadata=("", None, None, None)),
        usage("r8", meta={"app_id": "app1", "app_name": "App"}, billing_origin_product="APPS",
              identity_metadata=("odd", None, None, None), workspace_id="w9"),
        usage("r9", meta={"warehouse_id": "wh1"}, usage_end_time=dt.datetime(2023, 1, 1)),
    ], "a")
    land(spark, root, "billing_list_prices", [
        price(dt.datetime(2024, 1, 1), None, "0.5", "0.4"), price(dt.datetime(2024, 1, 1), None, "9", None, "EUR")], "a")
    land(spark, root, "query_history", [
        statement("s1", 3000, 1000), statement("s2", 6000), statement("s3", 10, cached=True),
        statement("s4", 5, warehouse=None), statement("s5", 100, warehouse="wh-unbilled")], "a")
    land(spark, root, "serving_endpoint_usage", [request("q1", "e1", 30), request("q2", "e1", 10), request("q3", "nobody", 10)], "a")
    land(spark, root, "serving_served_entities", [entity("e1", "ep1"), entity("e2", None)], "a")
    land(spark, root, "lakeflow_jobs", [job("j1", "one"), job("j2", "two", tags=None)], "a")
    land(spark, root, "lakeflow_pipelines", [], "a")
    land(spark, root, "compute_clusters", [], "a")
    land(spark, root, "compute_warehouses", [warehouse("wh1", "house")], "a")
    land(spark, root, "access_workspaces", [workspace("w1", "core-prod"), workspace("w2", "sandbox-dev")], "a")
    land(spark, root, "account_users", [user("u1", "ann@x.org"), user("u2", "bob@x.org", emails=[]),
                                        user("u3", "gone@x.org", deleted=h(1))], "a")
    land(spark, root, "account_service_principals", [principal("sp1", GUID)], "a")
    land(spark, root, "account_groups", [group("g1", ["Users/u1", "Groups/g2"]), group("g2", ["Users/u2", "ServicePrincipals/sp1"]),
                                         group("g3", None), group("g4", ["Users/u1"], deleted=h(1))], "a")


def second_day(spark, root):
    day2 = D + dt.timedelta(days=1)
    land(spark, root, "billing_usage", [
        usage("r1", meta={"warehouse_id": "wh1"}),
        usage("r10", meta={"warehouse_id": "wh1"}, ingestion_date=day2, usage_quantity=5.0),
    ], "b")
    land(spark, root, "lakeflow_jobs", [job("j1", "one again", 5, deleted=h(5)), job("j1", "late", -3)], "b")
    land(spark, root, "query_history", [statement("s2", 8000, update=3), statement("s6", 2000, status="FAILED")], "b")
    land(spark, root, "billing_list_prices", [
        price(dt.datetime(2024, 1, 1), None, "0.5", "0.4"), price(dt.datetime(2024, 1, 1), None, "9", None, "EUR")], "b")
    land(spark, root, "access_workspaces", [workspace("w1", "core-prod")], "b")
    land(spark, root, "account_groups", [group("g1", ["Users/u1"]), group("g2", ["Users/u2"])], "b")

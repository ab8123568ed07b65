import pytest
from pyspark.sql import functions as F

from costloom.plans.daily import Daily
from costloom.plans import measures as kpi
from tests import landing
from tests.conftest import rows


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("daily"))
    landing.first_day(spark, f"{root}/landed")
    run = Daily(spark, f"{root}/landed", f"{root}/lake")
    run.run()
    return run


def test_first_run(daily):
    gold = daily.gold()
    cost = {r.record_cd: r for r in gold["vf_pbi_billing_cost"].collect()}
    assert len(cost) == 9
    assert cost["r1"].line_cost_usd == pytest.approx(0.8) and cost["r9"].line_cost_usd is None
    resources = {(r.resource_type_lb, r.source_cd): r.resource_id for r in gold["vd_pbi_resource"].collect()}
    assert cost["r1"].resource_id == resources[("Warehouse", "wh1")] > 0
    assert cost["r3"].resource_id == resources[("Endpoint", "ep1")] > 0
    assert cost["r4"].resource_id == resources[("Job", "j1")] > 0
    assert cost["r5"].resource_id == resources[("Data Quality Monitoring", "dq1")] > 0
    assert cost["r6"].resource_id == -11
    assert cost["r7"].resource_id == resources[("Networking", "NETWORKING")] > 0
    assert cost["r8"].workspace_id == -3 and cost["r1"].workspace_id > 0
    people = {r.identity_cd: r.identity_id for r in gold["vd_pbi_identity"].collect()}
    assert cost["r1"].identity_id == people["ann@x.org"]
    assert cost["r4"].identity_id == people[landing.GUID]
    assert cost["r5"].identity_id == people["bob@x.org"] and cost["r5"].run_as_cd == "bob@x.org"
    assert cost["r6"].identity_id == 0 and cost["r7"].identity_id == 0 and cost["r8"].identity_id == -1
    assert cost["r1"].is_serverless_fl == "Yes" and cost["r1"].is_photon_fl == "No"


def test_first_run_attribution(daily):
    queries = {r.statement_cd: r for r in daily.gold()["vf_pbi_query_cost"].collect()}
    assert set(queries) == {"s1", "s2", "s3", "s5"}
    # Pool 0.8 + 1.2; weights 2000 and 6000; the line before the first price has no cost.
    assert queries["s1"].attributed_cost_usd == pytest.approx(0.5) and queries["s2"].attributed_cost_usd == pytest.approx(1.5)
    assert queries["s3"].attributed_cost_usd == 0 and queries["s5"].attributed_cost_usd is None
    assert queries["s5"].resource_id == -6 and queries["s1"].client_application_lb == "undefined"
    assert queries["s1"].job_cd == "j1" and queries["s1"].read_gb_nb == 1.5
    serving = {r.databricks_request_cd: r for r in daily.gold()["vf_pbi_serving_cost"].collect()}
    assert {k: round(v.attributed_cost_usd, 6) for k, v in serving.items()} == {"q1": 0.6, "q2": 0.2}
    assert serving["q1"].entity_id > 0


def test_first_run_directory_and_tags(daily):
    gold = daily.gold()
    assert rows(gold["vr_pbi_dbx_user_security"], "user_cd", "member_cd") == [
        ("u1", "sp1"), ("u1", "u1"), ("u1", "u2"), ("u2", "sp1"), ("u2", "u2"), ("u3", "u3")]
    users = {r.user_cd: r for r in daily.current("td_dbx_user").collect()}
    assert users["u3"].is_active_fl == 0 and users["u2"].primary_email_lb is None
    keys = {r.tag_key_cd: r.tag_key_id for r in gold["vd_pbi_tag_key"].collect()}
    assert {"Appid", "Environment", "Team", "Unknown", "Unassigned"} == set(keys)
    bridge = {(r.resource_id, r.tag_key_id): r.tag_value_lb for r in gold["vr_pbi_resource_tag"].collect()}
    resources = {(r.resource_type_lb, r.source_cd): r.resource_id for r in gold["vd_pbi_resource"].collect()}
    assert bridge[(resources[("Job", "j1")], keys["Team"])] == "x"
    assert bridge[(resources[("Job", "j2")], keys["Team"])] == "Untagged"
    assert bridge[(resources[("App", "app1")], keys["Appid"])] == "A1"
    assert bridge[(resources[("Warehouse", "wh1")], keys["Environment"])] == "prod"
    assert len(bridge) == gold["vd_pbi_resource"].filter("resource_id > 0").count() * 3


def test_second_run_is_incremental(daily, spark):
    gold = daily.gold()
    by_name = lambda g: {(r.resource_type_lb, r.workspace_cd, r.source_cd): r.resource_id for r in g["vd_pbi_resource"].collect()}
    before = by_name(gold)
    landing.second_day(spark, daily.landed)
    daily.run()
    gold = daily.gold()
    after = by_name(gold)
    assert {k: after[k] for k in before} == before
    cost = {r.record_cd: r.line_cost_usd for r in gold["vf_pbi_billing_cost"].collect()}
    assert len(cost) == 10 and cost["r10"] == pytest.approx(2.0)
    assert gold["vf_pbi_billing_cost"].count() == 10
    # A late line and late statements change every share of the day: pool 4.0, weights 2000, 8000, 2000.
    queries = {r.statement_cd: r for r in gold["vf_pbi_query_cost"].collect()}
    assert queries["s1"].attributed_cost_usd == pytest.approx(4.0 * 2 / 12, abs=1e-6)
    assert queries["s2"].attributed_cost_usd == pytest.approx(4.0 * 8 / 12, abs=1e-6)
    assert queries["s6"].execution_status_lb == "FAILED"
    history = daily.tables.read("td_lakeflow_job_history").filter("job_cd = 'j1'").orderBy("valid_from_dt").collect()
    assert [v.job_name_lb for v in history] == ["late", "one", "one again"]
    assert [v.is_current_fl for v in history] == [0, 0, 1]
    job = daily.tables.read("td_lakeflow_job").filter("job_cd = 'j1'").first()
    assert job.job_name_lb == "one again" and job.is_deleted_fl == 1
    spaces = {r.workspace_cd: r for r in gold["vd_pbi_workspace"].collect()}
    assert spaces["w2"].is_deleted_fl == "Yes" and spaces["w2"].environment_lb == "Development"
    assert spaces["Z_UNK"].is_deleted_fl == "No"
    members = {(r.group_cd, r.member_cd): r.is_deleted_fl for r in gold["vr_pbi_dbx_group_member"].collect()}
    assert members[("g1", "g2")] == "Yes" and members[("g1", "u1")] == "No"
    assert ("u1", "u2") not in rows(gold["vr_pbi_dbx_user_security"], "user_cd", "member_cd")


def test_rerun_without_news_changes_nothing(daily):
    names = ["td_resource", "td_identity", "tr_resource_tag", "tr_dbx_group_reach", "tr_dbx_group_closure", "td_tag_key"]
    before = {n: rows(daily.current(n)) for n in names}
    cost = rows(daily.tables.read("tf_billing_cost").drop("custom_tags"))
    kept = [*names, "td_workspace", "td_dbx_user", "td_dbx_service_principal", "td_dbx_group", "tr_dbx_group_member", "td_billing_list_price"]
    versions = {n: daily.tables.versions(n) for n in kept}
    daily.run()
    assert {n: daily.tables.versions(n) for n in kept} == versions  # no file is written
    assert {n: rows(daily.current(n)) for n in names} == before
    assert rows(daily.tables.read("tf_billing_cost").drop("custom_tags")) == cost


def shares(daily):
    return ({r.statement_cd: r.attributed_cost_usd for r in daily.gold()["vf_pbi_query_cost"].collect()},
            {r.databricks_request_cd: r.attributed_cost_usd for r in daily.gold()["vf_pbi_serving_cost"].collect()})


def lines(daily):
    return rows(daily.tables.read("tf_billing_cost"), "account_cd", "workspace_cd", "record_cd", "ingestion_dt", "line_cost_usd")


def test_lines_without_a_key_part_are_kept_once(daily, spark):
    before = len(lines(daily))
    odd = {"meta": {"warehouse_id": "wh1"}}
    landing.land(spark, daily.landed, "billing_usage", [
        landing.usage(None, **odd), landing.usage(None, **odd), landing.usage("n1", workspace_id=None, **odd),
        landing.usage("r1", account_id="other", **odd)], "c")
    daily.run()
    kept = lines(daily)
    assert len(kept) == before + 4
    marks = daily.current("_marks")
    daily.tables.replace("_marks", marks.filter("table_name <> 'tf_billing_cost'"))
    daily.run_cost()
    assert lines(daily) == kept
    broken = daily.tables.read("_expectations").filter("rule_lb = 'record_id not null' and failed_nb > 0")
    assert {r.failed_nb for r in broken.collect()} == {2}


def test_a_failure_in_attribution_is_made_good(daily, spark, monkeypatch):
    landing.land(spark, daily.landed, "billing_usage", [landing.usage("big", meta={"warehouse_id": "wh1"}, usage_quantity=100.0)], "d")
    monkeypatch.setattr(daily, "run_attribution", lambda days: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run()
    monkeypatch.undo()
    daily.run()
    seen = shares(daily)
    daily.run_attribution()
    assert shares(daily) == seen


def test_a_late_entity_is_charged(daily, spark):
    landing.land(spark, daily.landed, "serving_endpoint_usage", [landing.request("q9", "late", 40)], "e")
    daily.run()
    assert "q9" not in shares(daily)[1]
    landing.land(spark, daily.landed, "serving_served_entities", [landing.entity("late", "ep1")], "e")
    daily.run()
    seen = shares(daily)
    assert seen[1]["q9"] > 0
    daily.run_attribution()
    assert shares(daily) == seen


def test_a_write_that_stops_changes_nothing(daily, monkeypatch):
    before = lines(daily)
    daily.tables.replace("_marks", daily.current("_marks").filter("table_name <> 'tf_billing_cost'"))
    monkeypatch.setattr(daily.tables, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run_cost()
    monkeypatch.undo()
    assert lines(daily) == before
    daily.run_cost()
    assert lines(daily) == before


def test_full_refresh_ends_in_the_same_facts(daily, spark):
    fresh = Daily(spark, daily.landed, daily.root)
    before, charged = lines(daily), shares(daily)
    fresh.run(full=True)
    assert fresh.generation == 2 == Daily(spark, daily.landed, daily.root).generation
    assert lines(fresh) == before and shares(fresh) == charged


def test_days_are_read_from_their_own_folders(daily):
    plan = daily.tables.days("tf_billing_cost", "ingestion_dt", [landing.D])._jdf.queryExecution().executedPlan().toString()
    assert "1 paths" in plan
    late = daily.arrived_usage(landing.NOON)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_day_dt" in late


def test_views_answer_sql(daily, spark):
    daily.register_views()
    total = spark.sql("select sum(line_cost_usd) from vf_pbi_billing_cost").first()[0]
    assert total == pytest.approx(kpi.measure(daily.gold()["vf_pbi_billing_cost"], "total_cost").first()[0])


def fact_reads(daily, monkeypatch):
    """Names of the fact tables that are read from now on."""
    seen, facts = [], {"tf_billing_cost", "tf_query_history", "tf_serving_usage"}
    for method in ("read", "days"):
        whole = getattr(daily.tables, method)
        monkeypatch.setattr(daily.tables, method, lambda name, *a, whole=whole, **k: (seen.append(name), whole(name, *a, **k))[1])
    serving = daily.serving
    monkeypatch.setattr(daily, "serving", lambda: (seen.append("tf_serving_usage"), serving())[1])
    return lambda: [n for n in seen if n in facts]


def test_attribution_without_news_reads_no_fact(daily, monkeypatch):
    daily.run()
    seen = fact_reads(daily, monkeypatch)
    attributed = daily.tables.next_load("mvf_query_cost_attribution")
    daily.run_stale_attribution()
    assert seen() == [] and daily.tables.next_load("mvf_query_cost_attribution") == attributed


def test_attribution_reads_the_folders_of_stale_days_alone(daily, spark, monkeypatch):
    import datetime as dt

    other = dt.date(2023, 5, 6)
    landing.land(spark, daily.landed, "billing_usage", [
        landing.usage("far1", meta={"warehouse_id": "wh1"}, usage_date=other, ingestion_date=other),
        landing.usage("far2", meta={"warehouse_id": "wh1"}, usage_date=other, ingestion_date=other + dt.timedelta(days=3))], "far")
    daily.run_streams()
    daily.run_cost()
    read = []
    days = daily.tables.days
    monkeypatch.setattr(daily.tables, "days", lambda name, day, wanted: (read.append((name, sorted(wanted))), days(name, day, wanted))[1])
    daily.run_stale_attribution()
    assert read == [("tf_billing_cost", [other, other + dt.timedelta(days=3)]), ("tf_query_history", [other])]
    plan = daily.serving().filter(F.col("request_day_dt").isin([other]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [request_day_dt" in plan.replace("isnotnull(request_day_dt#", "") or "request_day_dt" in plan.split("PartitionFilters")[1][:200]


def test_facts_stored_before_the_index_are_indexed_once(daily, monkeypatch):
    monkeypatch.setattr(daily.index, "name", "_load_index_again")
    seen = shares(daily)
    daily.run_stale_attribution()
    assert {n for n in ("tf_billing_cost", "tf_query_history", "tf_serving_usage") if daily.index.known(n)} == {
        "tf_billing_cost", "tf_query_history", "tf_serving_usage"}
    assert shares(daily) == seen
    reads = fact_reads(daily, monkeypatch)
    daily.run_stale_attribution()
    assert reads() == []


def test_both_rule_sets_are_counted(daily):
    found = daily.tables.read("_expectations")
    assert {r.table_name for r in found.collect()} == {"tf_billing_usage", "tf_serving_usage"}
    stored = {n: daily.tables.read(n).count() if n in ("tf_billing_cost",) else None for n in ("tf_billing_cost",)}
    per = {r.table_name: r.n for r in found.groupBy("table_name", "rule_lb").agg(F.sum("checked_nb").alias("n")).select("table_name", "n").distinct().collect()}
    assert per["tf_serving_usage"] == daily.serving().count() and per["tf_billing_usage"] >= stored["tf_billing_cost"]


def test_closure_follows_the_directory(daily, spark):
    from costloom.operators import closure as groups

    edges = daily.current("tr_dbx_group_member").filter("is_deleted_fl = 0")
    assert rows(daily.current("tr_dbx_group_closure")) == rows(groups.closure(edges, ["account_cd"]))
    versions = daily.tables.versions("tr_dbx_group_closure")
    daily.run_visibility()
    assert daily.tables.versions("tr_dbx_group_closure") == versions
    changed = daily.current("tr_dbx_group_member").withColumn("is_deleted_fl", F.lit(1) - F.col("is_deleted_fl"))
    daily.tables.replace("tr_dbx_group_member", changed)
    daily.run_visibility()
    edges = changed.filter("is_deleted_fl = 0")
    assert rows(daily.current("tr_dbx_group_closure")) == rows(groups.closure(edges, ["account_cd"]))
    assert rows(daily.current("tr_dbx_group_reach"), "account_cd", "group_cd", "inner_cd") == rows(groups.reachable_groups(edges, ["account_cd"]))


def test_a_full_refresh_that_fails_leaves_the_current_generation(daily, spark, monkeypatch):
    before, charged = daily.generation, shares(daily)
    monkeypatch.setattr(Daily, "run_resources", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run(full=True)
    monkeypatch.undo()
    assert daily.generation == before and shares(daily) == charged
    daily.run(full=True)
    assert daily.generation > before and shares(daily) == charged
    assert Daily(spark, daily.landed, daily.root).generation == daily.generation


def test_landed_fields_that_no_one_declared_reach_the_facts(daily, spark):
    """A new column, and a new field inside a struct, of lines and statements; older rows read NULL."""
    from pyspark.sql import types as T

    def land_with(table, rows, name, **new):
        landing.land(spark, f"{daily.root}/aside", table, rows, name)
        spark.read.parquet(f"{daily.root}/aside/{table}/{name}").withColumns(new).write.parquet(f"{daily.landed}/{table}/{name}")

    meta = F.col("usage_metadata")
    land_with("billing_usage", [landing.usage("x1", meta={"warehouse_id": "wh1"})], "wide",
              spot_lb=F.lit("spot"), usage_dt=F.lit("clash"), usage_metadata=meta.withField("zone_id", F.lit("z1")))
    daily.run()
    cost = daily.tables.read("tf_billing_cost")
    seen = {r.record_cd: (r.spot_lb, r.usage_dt_landed, r.usage_metadata.zone_id) for r in cost.collect()}
    assert seen["x1"] == ("spot", "clash", "z1") and seen["r1"] == (None, None, None)
    assert isinstance(cost.schema["usage_dt"].dataType, T.DateType)
    facts = {r.record_cd: r.line_cost_usd for r in daily.gold()["vf_pbi_billing_cost"].collect()}
    assert facts["x1"] is not None
    versions = daily.tables.versions("_schemas")
    before = lines(daily)
    daily.run()
    assert daily.tables.versions("_schemas") == versions and lines(daily) == before

"""Registered queries against DuckDB on the smallest test tables.

A cross-section by default; ``CHECK_ALL=1`` runs every query.
"""

import os

import pytest

from checks import compare as c, queries as q
from checks.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "cost_by_day_workspace_product", "reprice_corrected_windows", "billing_network", "scd1_late_batch_first", "scd2_incremental",
    "merge_price_snapshot", "merge_workspace_snapshot", "merge_group_members", "user_visibility", "resource_tag_bridge",
    "query_cost_allocation", "serving_cost_allocation", "gold_billing_cost", "gold_query_cost", "calendar", "period_totals",
    "monthly_trend", "query_duration_percentile", "top_products_skip_rank", "report_cost_by_domain_rollup",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return c.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("CHECK_ALL") else SAMPLE)
def test_query_equals_sql(spark, con, name):
    line = c.compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert line.startswith("ok"), line


def test_no_python_runs_in_the_tasks(spark):
    for name in ("gold_billing_cost", "query_cost_allocation", "cost_measures_by_product"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name
        assert "CartesianProduct" not in plan, name


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.columns == ["usage_dt", "workspace_cd", "product_lb", "total_cost", "lines_nb"]
    assert out.limit(1).count() == 1


def test_star_finds_the_resources_once(spark):
    from checks import queries as q

    plan = q.star_cost(spark, "/root/testdata/sf0.001").select("resource_lb", "resource_id")._jdf.queryExecution().analyzed().toString()
    assert plan.count("resource_type_lb") and "having" not in plan and not [x for x in plan.splitlines() if "max(usage_dt" in x]


def test_two_batches_price_their_lines_once(spark, monkeypatch):
    from checks import queries as q

    runs = []
    monkeypatch.setattr(q, "cost", lambda *a, f=q.cost: runs.append(1) or f(*a))
    q.QUERIES["cost_load_two_batches"](spark, "/root/testdata/sf0.001")
    assert len(runs) == 1


def test_facts_of_few_columns_read_the_lines_once_and_skip_joins(spark, monkeypatch):
    from checks import queries as q

    plan = q.gold_cost(spark, SF, ["usage_dt", "line_cost_usd"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Window" not in plan and "l_orderkey" not in plan
    tables = q._resource_tables(spark, SF)
    assert not [n for n, t in tables.items() if "l_orderkey" in t._jdf.queryExecution().analyzed().toString()]


def test_lines_in_sparks_order_of_joins_are_those_of_the_view(spark):
    from checks import fixtures as fx

    frames = {n: fx.table(spark, SF, n) for n in fx.needs("fx_usage")}
    told = spark.sql(fx._dialect(fx.VIEWS["fx_usage"], 0), **frames)
    ours = fx.view(spark, SF, "fx_usage")
    assert ours.schema == told.schema and ours.exceptAll(told).isEmpty() and told.exceptAll(ours).isEmpty()
    text = ours._jdf.queryExecution().analyzed().toString()
    assert text.count("Window") == 1 and text.index("AWS") < text.index("Window")


@pytest.mark.parametrize("name", ["cost_load_null_keys", "cost_load_two_batches", "merge_cost_increment", "price_line_cost_asof"])
def test_usage_lines_are_found_once_for_prices_and_loads(spark, monkeypatch, name):
    from checks import queries as q

    read = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey")
    kept = []
    monkeypatch.setattr(q, "staged", lambda df, f=q.staged: kept.append(read(df)) or f(df))
    assert read(q.QUERIES[name](spark, SF)) == 0 and sum(kept) == 1


def test_reports_that_ask_for_no_resource_find_none(spark, monkeypatch):
    from checks import queries as q

    kept = []
    monkeypatch.setattr(q, "kept_usage", lambda spark, sf, columns, f=q.kept_usage: kept.append(columns) or f(spark, sf, columns))
    out = q.star_cost(spark, SF, ["product_lb", "identity_type_lb", "line_cost_usd"])
    assert "source_cd" not in out._jdf.queryExecution().optimizedPlan().toString()
    q.star_cost(spark, SF, ["product_lb", "line_cost_usd"])
    assert not {*q._CODES} & {*kept[0]} and {*q._LOGINS} <= {*kept[0]} and not {*q._LOGINS} & {*kept[1]}


@pytest.mark.parametrize("places, parts, apart", [
    ([(1, 0), (2, 0)], [(5, 7), (None, None)], True), ([(1, 0), (1, 0), (None, 2)], [(5, 7)], True), ([], [], True), ([(1, 0), (1, 2)], [(5, 7)], False),
    ([(1, 0), (1, None)], [(5, 7)], False), ([(100, 0)], [(5, 7)], False), ([(1, 0)], [(5, 100000000)], False), ([(1, 0)], [(-5, 7)], False)])
def test_numbers_that_could_meet_in_one_resource_are_counted(spark, frame, tmp_path, places, parts, apart):
    from checks import queries as q

    frame("n_nationkey int, n_regionkey int", places).write.parquet(f"{tmp_path}/nation.parquet")
    frame("l_partkey bigint, l_suppkey bigint", parts).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert q._numbers_apart(spark, str(tmp_path)) is apart


def test_only_lines_since_the_day_are_grouped_to_resources(spark):
    from checks import fixtures as fx

    ours = fx.view(spark, SF, "fx_resource")
    told = spark.sql(fx._dialect(fx.VIEWS["fx_resource"], 0), fx_usage=fx.view(spark, SF, "fx_usage"))
    assert ours.schema == told.schema and ours.exceptAll(told).isEmpty() and told.exceptAll(ours).isEmpty()
    assert "max(usage_dt" not in ours._jdf.queryExecution().optimizedPlan().toString()

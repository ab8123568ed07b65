import datetime as dt

import pytest
from pyspark.sql import functions as F

from costloom.functions import labels, rules
from costloom.plans import calendar as cal, gold, measures as kpi, periods, reports, resources as res, silver
from tests import landing
from tests.conftest import rows

D = dt.date


# ---- periods ---------------------------------------------------------------

@pytest.mark.parametrize("period,as_of,prior,want", [
    ("MTD", D(2024, 3, 31), False, (D(2024, 3, 1), D(2024, 3, 31))),
    ("MTD", D(2024, 2, 29), True, (D(2023, 2, 1), D(2023, 2, 28))),
    ("QTD", D(2024, 5, 10), False, (D(2024, 4, 1), D(2024, 5, 10))),
    ("YTD", D(2024, 5, 10), True, (D(2023, 1, 1), D(2023, 5, 10))),
    ("WTD", D(2024, 1, 3), False, (D(2024, 1, 1), D(2024, 1, 3))),
    ("WTD", D(2021, 1, 2), False, (D(2021, 1, 1), D(2021, 1, 2))),
    ("L3M", D(2024, 4, 30), False, (D(2024, 2, 1), D(2024, 4, 30))),
    ("L3M", D(2024, 5, 15), False, (D(2024, 2, 16), D(2024, 5, 15))),
    ("L3M", D(2024, 5, 15), True, (D(2023, 12, 1), D(2024, 2, 29))),
    ("MAT", D(2024, 2, 29), False, (D(2023, 3, 1), D(2024, 2, 29))),
    ("MAT", D(2024, 12, 31), True, (D(2023, 1, 1), D(2023, 12, 31))),
    ("L6M", D(2024, 12, 31), True, (D(2024, 1, 1), D(2024, 6, 30))),
    ("L9M", D(2024, 9, 30), False, (D(2024, 1, 1), D(2024, 9, 30))),
])
def test_period_bounds(period, as_of, prior, want):
    assert periods.period_bounds(period, as_of, prior) == want


def test_context_periods():
    assert periods.period_bounds("CURRENT", D(2024, 3, 31), True, D(2024, 2, 1)) == (D(2023, 2, 1), D(2023, 3, 31))
    assert periods.period_bounds("PRIOR MONTH", D(2024, 3, 31), first=D(2024, 1, 15)) == (D(2023, 12, 1), D(2023, 12, 31))
    with pytest.raises(ValueError):
        periods.period_bounds("nope", D(2024, 1, 1))


def test_the_last_date_is_the_end_of_the_month(frame):
    df = frame("usage_dt date, c double", [(D(2024, 2, 3), 1.0), (D(2024, 1, 9), 2.0)])
    assert periods.last_context_date(df) == D(2024, 2, 29)
    assert periods.period_total(df, "c", "MTD").first()[0] == 1.0
    assert periods.period_total(df, "c", "L3M").first()[0] == 3.0


def test_months_without_data_are_gaps(frame):
    df = frame("usage_dt date, c double", [(D(2023, 1, 5), 10.0), (D(2024, 1, 9), 15.0), (D(2024, 3, 1), 3.0)])
    got = {(r.year, r.month_nb): r for r in periods.monthly_trend(df, "c").collect()}
    assert got[(2024, 1)].ly == 10.0 and got[(2024, 1)].yoy_pct == 0.5
    assert got[(2024, 3)].prior_month is None and got[(2024, 3)].ytd == 18.0 and got[(2024, 3)].mat == 18.0


def test_period_comparison_edges(frame):
    df = frame("g string, usage_dt date, c double", [
        ("up", D(2023, 1, 1), 2.0), ("up", D(2024, 1, 1), 3.0), ("new", D(2024, 1, 1), 3.0),
        ("zero", D(2023, 1, 1), 0.0), ("zero", D(2024, 1, 1), 3.0), ("gone", D(2023, 1, 1), 2.0)])
    got = dict(rows(periods.period_comparison(df, "c", 2024, ["g"])))
    assert got == {"up": 0.5, "new": None, "zero": 0.0, "gone": -1.0}
    assert set(r[1] for r in rows(periods.period_comparison(df, "c", None, ["g"]))) == {None}


# ---- calendar --------------------------------------------------------------

def test_calendar_weeks_restart_with_the_year(spark):
    days = {r.date: r for r in cal.calendar(spark, D(2020, 12, 1), D(2023, 1, 31)).collect()}
    assert len(days) == 31 + 365 + 365 + 31
    assert days[D(2023, 1, 1)].week == "2023-W01" and days[D(2023, 1, 2)].week == "2023-W02"
    assert days[D(2020, 12, 31)].week_of_year_number == 53 and days[D(2021, 1, 1)].week_of_year_number == 1
    one = days[D(2022, 5, 16)]
    assert (one.quarter, one.month, one.month_of_quarter, one.day_of_week_name, one.day_of_quarter) == (
        "Q2.2022", "May 2022", "QM2", "Monday", 46)
    assert len(cal.calendar(spark, D(2024, 1, 1), D(2024, 1, 1)).columns) == 25


# ---- charged resource and identity ----------------------------------------

def charged(spark, compat=False, **meta):
    product = meta.pop("product", "SQL")
    row = landing.usage("r", meta=meta, billing_origin_product=product)
    df = silver.usage_fact(landing.frame(spark, "billing_usage", [row]))
    return tuple(df.select(rules.resource_type(compat), rules.resource_source(compat)).first())


def test_resource_precedence(spark):
    assert charged(spark, job_id="j", cluster_id="c") == ("JOB", "j")
    assert charged(spark, cluster_id="c", warehouse_id="w") == ("WAREHOUSE", "w")
    assert charged(spark, product="NETWORKING") == ("NETWORKING", "NETWORKING")
    assert charged(spark, networking_client="n", schema_id="s") == ("NETWORKING", "n")
    assert charged(spark, compat=True, networking_client="n", schema_id="s") == ("NETWORKING", "s")
    assert charged(spark, schema_id="s") == ("DATA QUALITY MONITORING", "s")
    assert charged(spark, compat=True, schema_id="s") == ("DATA_QUALITY_MONITORING", "s")
    assert charged(spark, product="PREDICTIVE_OPTIMIZATION") == ("PREDICTIVE OPTIMIZATION", "PREDICTIVE_OPTIMIZATION")
    assert charged(spark, product="STORAGE") == ("STORAGE", "STORAGE")


def test_identity_shapes(frame):
    df = frame("l string", [(None,), ("",), (landing.GUID,), ("a@b",), ("odd",)])
    assert [r[0] for r in df.select(rules.unknown_identity("l")).collect()] == [0, 0, -4, -3, -1]


def test_text_fields_from_structs_and_json(spark):
    paths = {"a": "x", "b": "y.z", "d": "none.at"}
    for sql in ("select '{\"x\":\"1\",\"y\":{\"z\":\"2\"}}' as c", "select named_struct('x','1','y',named_struct('z','2')) as c"):
        df = spark.sql(sql)
        assert tuple(labels.with_nested_text(df, "c", paths).select("a", "b", "d").first()) == ("1", "2", None)
    as_map = spark.sql("select map('k','v') as c")
    assert as_map.select(labels.map_or_json(as_map, "c")).first()[0] == {"k": "v"}


def test_environments(frame):
    df = frame("n string", [("DEV-prod",), ("x-Staging",), ("prod",), (None,)])
    assert [tuple(r) for r in df.select(labels.environment("n"), labels.environment_order("n")).collect()] == [
        ("Development", 3), ("Staging", 2), ("Production", 1), ("Other", 4)]


# ---- silver and resources --------------------------------------------------

def test_entity_without_key_is_left_out(spark):
    lines = landing.frame(spark, "billing_usage", [
        landing.usage("r1", billing_origin_product="DATA_QUALITY_MONITORING"),
        landing.usage("r2", meta={"schema_id": "s"}, billing_origin_product="DATA_QUALITY_MONITORING")])
    assert silver.extract_entity(lines, silver.MONITOR).count() == 2
    assert rows(silver.billing_entity(lines, silver.MONITOR), "dqm_cd") == [("s",)]
    for spec in (*silver.CHANGE_FED, *silver.BILLING_ENTITIES):
        assert [r[spec.id_col] for r in spec.sentinels] == [-2, -1]


def test_prices_that_are_not_numbers(spark):
    df = landing.frame(spark, "billing_list_prices", [landing.price(landing.NOON, None, "n/a", "0.25")])
    assert rows(silver.price_view(df), "default_price_nb", "effective_list_price_nb") == [(None, 0.25)]


def test_resources_of_the_earlier_form(frame):
    dim = "account_cd string, workspace_cd string, "
    tables = {
        "td_billing_endpoint": frame(dim + "endpoint_id bigint, endpoint_cd string, endpoint_name_lb string, run_as_cd string, product_lb string",
                                     [("a", "w", 1, "e", "E", "me", "MODEL_SERVING"), ("a", "w", -1, "UNK", "U", "U", "UNK")]),
        "td_billing_app": frame(dim + "app_id bigint, app_cd string, app_name_lb string, run_as_cd string", [("a", "w", 1, "x", "X", "me")]),
    }
    out = res.unify_resources_earlier(tables)
    assert rows(out, "resource_type_lb", "source_cd", "owned_by_cd") == [("APP", "x", "me"), ("MODEL_SERVING", "e", None)]
    now = res.unify_resources(tables)
    assert rows(now, "resource_type_lb", "source_cd", "owned_by_cd") == [("APP", "x", "me"), ("ENDPOINT", "e", "me")]


def test_billing_fact_compat_leaves_monitors_unresolved(spark, frame):
    lines = silver.usage_fact(landing.frame(spark, "billing_usage", [
        landing.usage("r", meta={"schema_id": "s"}, billing_origin_product="DATA_QUALITY_MONITORING")])).withColumn("line_cost_usd", F.lit(1.0))
    spaces = frame("workspace_id bigint, account_cd string, workspace_cd string", [(1, "acct", "w1")])
    things = frame("resource_id bigint, resource_type_lb string, source_cd string, account_cd string, workspace_cd string",
                   [(5, "DATA QUALITY MONITORING", "s", "acct", "w1")])
    people = frame("identity_id bigint, account_cd string, identity_cd string, is_active_fl int", [])
    fact = lambda compat: gold.billing_cost_fact(lines, spaces, things, people, compat).first().resource_id
    assert fact(False) == 5 and fact(True) == -11


def billed(spark, frame, twice=False):
    """Lines of two jobs, an unknown one and one without a login, and their dimensions; ``twice``: an identity stands in two rows."""
    line = lambda n, job, login: landing.usage(n, meta={"job_id": job}, identity_metadata={"run_as": login, "run_by": None, "created_by": None, "owned_by": None})
    landed = landing.frame(spark, "billing_usage", [line("r1", "j1", "ann"), line("r2", "j2", "bob"), line("r3", "j9", "ann"), line("r4", "j1", None)])
    lines = silver.usage_fact(landed).withColumn("line_cost_usd", F.lit(1.0))
    spaces = frame("workspace_id bigint, account_cd string, workspace_cd string, workspace_lb string", [(1, "acct", "w1", "space")])
    things = frame("resource_id bigint, resource_type_lb string, source_cd string, account_cd string, workspace_cd string, display_name_lb string, owned_by_cd string, is_active_fl int",
                   [(5, "JOB", "j1", "acct", "w1", "job 1", "ann", 1), (6, "JOB", "j2", "acct", "w1", "job 2", None, 0), (-3, "JOB", "UNK", "UNK", "UNK", "Unknown", None, 1)])
    people = frame("identity_id bigint, account_cd string, identity_cd string, identity_type_lb string, display_name_lb string, is_active_fl int",
                   [(1, "acct", "ann", "USER", "Ann", 1), (2, "acct", "bob", "USER", "Bob", 1), (0, "UNK", "UNK", "NONE", "No login", 1)] + [(1, "acct", "ann", "USER", "Ann", 1)] * twice)
    return lines, spaces, things, people


@pytest.mark.parametrize("twice", [False, True])
def test_star_of_the_billing_fact_joins_each_dimension_once(spark, frame, twice):
    lines, spaces, things, people = billed(spark, frame, twice)
    whole = kpi.star(gold.billing_cost_fact(lines, spaces, things, people), *[
        (dim, k, {c: n for n, c in gold.STAR[k].items()})
        for k, dim in (("workspace_id", spaces), ("resource_id", gold.resource_dim(things)), ("identity_id", people))])
    for names in (["record_cd", "workspace_lb", "resource_lb", "resource_type_lb", "owned_by_cd", "is_active_fl", "identity_lb", "identity_id"],
                  ["record_cd", "workspace_lb"], ["record_cd", "resource_id", "resource_lb"]):
        out = gold.billing_cost_star(lines, spaces, things, people, names)
        assert rows(out) == rows(whole.select(*names)), names
    few = gold.billing_cost_star(lines, spaces, things, people, ["record_cd", "workspace_lb"])
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Join") == (4 if twice else 2)
    fact = gold.billing_cost_fact(lines, spaces, things, people, surrogates=["workspace_id"])
    assert fact.columns[4] == "workspace_id" and "resource_id" not in fact.columns and fact.count() == 4


def test_what_other_columns_tell_does_not_travel_with_the_lines(spark, frame):
    inputs = billed(spark, frame)
    fact = gold.billing_cost_fact(*inputs)
    below = lambda df: [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines()[1:] if "Project" in x]
    assert not [x for x in below(fact) if "Yes" in x or "THEN JOB" in x]
    few = ["record_cd", "is_photon_fl", "resource_id"]
    narrow = gold.billing_cost_fact(*inputs, shown=few).select(*few)
    assert rows(narrow) == rows(fact, *few) and {r[2] for r in rows(narrow)} == {5, 6, -3}
    assert [x for x in below(narrow) if "THEN JOB" in x]


def test_dimensions_known_to_be_unique_and_not_asked_for_are_never_read(spark, frame):
    lines, spaces, things, people = billed(spark, frame)
    broken = things.withColumn("resource_id", F.raise_error(F.lit("read")).cast("bigint"))
    out = gold.billing_cost_star(lines, spaces, broken, people, ["record_cd", "workspace_lb"], unique=["resource_id", "identity_id"])
    assert rows(out) == [(f"r{n}", "space") for n in range(1, 5)]


# ---- measures and reports --------------------------------------------------

def cost_fact(frame):
    return frame("usage_dt date, ingestion_dt date, workspace_id bigint, identity_id bigint, resource_id bigint, line_cost_usd double, "
                 "usage_quantity_nb double, usage_unit_lb string, is_serverless_fl string, is_photon_fl string, g string", [
        (D(2024, 1, 1), D(2024, 1, 2), 1, 1, 1, 4.0, 2.0, "DBU", "Yes", "No", "a"),
        (D(2024, 1, 2), D(2024, 1, 3), 1, -3, 2, 6.0, 3.0, "GB", "No", "No", "a"),
        (D(2024, 1, 3), D(2024, 1, 4), -3, 0, -2, None, 0.0, "DBU", "No", "No", None)])


def test_measure_groups_and_blank_ratios(frame):
    names = ["total_cost", "avg_daily_cost", "days_with_cost", "serverless_cost_pct", "avg_cost_per_unit", "active_workspaces", "peak_daily_cost"]
    got = {r.g: r for r in kpi.measure(cost_fact(frame), names, ["g"]).collect()}
    assert (got["a"].total_cost, got["a"].avg_daily_cost, got["a"].serverless_cost_pct, got["a"].peak_daily_cost) == (10.0, 5.0, 0.4, 6.0)
    assert got[None].total_cost is None and got[None].days_with_cost == 1 and got[None].avg_cost_per_unit is None
    total = kpi.measure(cost_fact(frame), names).first()
    assert total.active_workspaces == 2 and total.days_with_cost == 3 and total.peak_daily_cost == 6.0
    assert kpi.measure(cost_fact(frame), "latest_data_date").first()[0] == D(2024, 1, 4)
    empty = kpi.measure(cost_fact(frame), "avg_daily_cost", filters=[F.col("g") == "none"]).first()
    assert empty.avg_daily_cost is None


def test_measures_apart_read_only_their_columns(frame):
    fact, asked = cost_fact(frame), []
    names = ["total_cost", "avg_daily_cost", "active_resources", "cost_per_identity", "peak_daily_cost"]
    part = lambda columns: asked.append(list(columns)) or fact.select(*columns)
    columns = ["g", "usage_dt", "line_cost_usd"]
    assert rows(kpi.measure_apart(part, columns, names, ["g"])) == rows(kpi.measure(fact, names, ["g"]))
    assert sorted(asked) == sorted([columns, ["g", "resource_id"], ["g", "identity_id"]])


def test_every_measure_computes(frame, spark):
    queries = frame("statement_cd string, identity_id bigint, attributed_cost_usd double, warehouse_cost_usd double, read_gb_nb double, "
                    "total_duration_ms_nb bigint, waiting_at_capacity_ms_nb bigint, waiting_for_compute_ms_nb bigint, "
                    "from_result_cache_fl string, execution_status_lb string", [
        ("a", 1, 2.0, 5.0, 0.0, 400000, 100, None, "No", "FAILED"), ("b", -1, None, 5.0, 0.0, None, None, None, "Yes", "FINISHED")])
    facts = {kpi.COST: cost_fact(frame), kpi.QUERY: queries}
    for fact in facts:
        names = [n for n in kpi.BASE if kpi.BASE[n][0] == fact]
        names += [n for n, (a, _, _) in kpi.RATIOS.items() if kpi.BASE[a][0] == fact] + [n for n, f in kpi.SPECIAL.items() if f == fact]
        assert kpi.measure(facts[fact], names).count() == 1
    q = kpi.measure(queries, ["query_users", "avg_query_duration_s", "p90_query_duration_s", "cost_per_gb_read", "long_running_statements",
                              "failed_statement_rate", "queue_time_share"]).first()
    assert (q.query_users, q.avg_query_duration_s, q.p90_query_duration_s, q.cost_per_gb_read, q.long_running_statements) == (1, 400.0, 400.0, None, 1)
    assert q.failed_statement_rate == 0.5 and q.queue_time_share == 100 / 400000


def test_matrix_has_every_value(frame):
    df = frame("r string, c string, v double", [("x", "b", 1.0), ("x", "a", 2.0), ("y", "a", 3.0), ("x", "a", 0.5), ("y", None, 4.0)])
    out = reports.matrix(df, ["r"], "c", "v")
    assert set(out.columns) == {"r", "a", "b", "null"}
    assert rows(out, "r", "a", "b", "null") == [("x", 2.5, 1.0, None), ("y", 3.0, None, 4.0)]
    assert all("staged-" in f for f in out.inputFiles()) and out.inputFiles()


def test_shared_resources_count_once_per_cell(frame):
    cost = frame("resource_id bigint, usage_dt date, line_cost_usd double", [(1, D(2024, 1, 5), 10.0), (2, D(2024, 1, 6), 1.0), (9, D(2024, 1, 6), 50.0)])
    bridge = frame("resource_id bigint, tag_key_id bigint, tag_value_lb string", [(1, 1, "A"), (1, 1, "B"), (2, 1, "A"), (9, 1, "Untagged"), (9, 2, "A")])
    keys = frame("tag_key_id bigint, tag_key_cd string", [(1, "Appid"), (2, "Team")])
    apps = frame("application_cd string, application_lb string, domain_lb string, sub_domain_lb string",
                 [("A", "App A", "D1", "S1"), ("B", "App B", "D1", "S2")])
    out = reports.cost_by_tag_domain(cost, bridge, keys, apps, rollup=True)
    got = {(r.level_nb, r.domain_lb, r.sub_domain_lb, r.application_lb): r.total_cost for r in out.collect()}
    assert got == {(3, "D1", "S1", "App A"): 11.0, (3, "D1", "S2", "App B"): 10.0, (2, "D1", "S1", None): 11.0, (2, "D1", "S2", None): 10.0,
                   (1, "D1", None, None): 11.0, (0, None, None, None): 11.0}


def test_star_keeps_rows(frame):
    fact = cost_fact(frame)
    dim = frame("resource_id bigint, name string, owned_by_cd string", [(1, "one", "ann"), (2, "two", None)])
    owners = frame("identity_cd string, display_name_lb string", [("ann", "Ann"), ("ann", "Ann B")])
    out = kpi.star(fact, (dim, "resource_id", {"name": "resource_lb", "owned_by_cd": "owned_by_cd"}), owners=owners)
    assert rows(out, "resource_id", "resource_lb", "owner_name_lb") == [(-2, None, None), (1, "one", "Ann"), (2, "two", None)]


def test_bitmaps_are_made_after_the_shuffle(frame):
    from costloom.plans import daily_state as state

    fact = frame("usage_dt date, resource_id bigint", [(D(2024, 1, n % 3 + 1), n) for n in range(50)])
    plan = state.distinct_state(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("bitmap_construct_agg") < plan.index("Exchange")
    above = plan[: plan.index("Exchange")]
    assert above.count("partial_bitmap_construct_agg") and "partial_bitmap_construct_agg" not in plan[plan.index("Exchange"):]


def test_daily_state_equals_the_fact(frame):
    """Distinct surrogates and percentiles of every period form, from a state that was replaced in part."""
    import datetime as dt
    import random

    from costloom.operators.ranking import percentile_inc
    from costloom.plans import daily_state as state, periods

    rnd, start = random.Random(3), dt.date(2022, 11, 3)
    data = [(start + dt.timedelta(days=rnd.choice([n % 9, n % 500])), rnd.choice("ab"), rnd.choice([None, -3, rnd.randrange(1, 90), 40_000]), rnd.randrange(50))
            for n in range(1500)]
    fact = frame("usage_dt date, g string, resource_id bigint, ms bigint", data + [(None, "a", 5, 5)])
    days = sorted({d for d, *_ in data})[::3]
    wrong = fact.withColumn("resource_id", F.lit(77).cast("bigint"))
    seen = state.replace_days(state.distinct_state(wrong.filter(F.col("usage_dt").isin(days)), by=["g"]).unionByName(
        state.distinct_state(fact.filter(~F.col("usage_dt").isin(days)), by=["g"])),
        state.distinct_state(fact.filter(F.col("usage_dt").isin(days)), by=["g"]), days)
    as_of = periods.last_context_date(fact)
    table = {r.g: r for r in state.distinct_table(seen, by=["g"]).collect()}
    counts = state.count_state(fact, "ms", ["g"])
    for period in ("MTD", "QTD", "WTD", "YTD", "L3M", "MAT"):
        for prior in (False, True):
            lo, hi = periods.period_bounds(period, as_of, prior)
            for g in "ab":
                want = len({r for d, x, r, _ in data if x == g and r is not None and lo <= d <= hi})
                assert table[g][f"{period.lower()}{'_prior' if prior else ''}"] == want
    for period, prior in (("YTD", False), ("MAT", True)):
        lo, hi = periods.period_bounds(period, as_of, prior)
        inside = fact.filter(F.col("usage_dt").between(F.lit(lo), F.lit(hi)))
        assert rows(state.percentile_total(counts, "ms", 0.9, period, as_of, prior, ["g"])) == rows(percentile_inc(inside, "ms", 0.9, ["g"]))
        assert {r.g: r.distinct_nb for r in state.distinct_total(seen, period, as_of, prior, ["g"]).collect()} == {
            r.g: r.n for r in inside.groupBy("g").agg(F.count_distinct("resource_id").alias("n")).collect()}
    trend = {(r.g, r.year, r.month): r for r in state.distinct_trend(seen, ["g"]).collect()}
    month = lambda d: d.year * 12 + d.month - 1
    for (g, y, m), r in trend.items():
        at = y * 12 + m - 1
        got = lambda lo, hi: len({x for d, k, x, _ in data if k == g and x is not None and lo <= month(d) <= hi})
        assert (r.month_nb, r.ytd_nb, r.mat_nb, r.ly_nb or 0, r.prior_month_nb or 0) == (
            got(at, at), got(y * 12, at), got(at - 11, at), got(at - 12, at - 12), got(at - 1, at - 1))
    assert len(trend) == len({(k, month(d)) for d, k, x, _ in data if x is not None})

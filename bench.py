"""Headline timings. Prints one JSON line.

The billing-shaped inputs are derived from the test tables and written once, outside the
timings, as the landed and silver tables would be; each query then reads them from
Parquet and writes to a sink that drops the rows. Reported is the median of three runs
after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import queries as q  # noqa: E402
from checks.fixtures import landed_usage, view  # noqa: E402
from costloom.operators import cdc, closure as groups, tags  # noqa: E402
from costloom.operators.merge import merge  # noqa: E402
from costloom.plans import costing, gold, measures as kpi, periods, resources as res, silver  # noqa: E402
from costloom.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def stage(spark, out: str):
    """Write the inputs and return a reader for them."""
    frames = {
        "usage": silver.usage_fact(landed_usage(view(spark, SF_DIR, "fx_usage"))),
        "price": view(spark, SF_DIR, "fx_price"),
        "workspace": view(spark, SF_DIR, "fx_workspace"),
        "resource": view(spark, SF_DIR, "fx_resource"),
        "identity": view(spark, SF_DIR, "fx_identity"),
        "history": q.history(spark, SF_DIR),
        "serving": q.serving(spark, SF_DIR),
        "entity": q.entities(spark, SF_DIR),
        "billed": q.billed(spark, SF_DIR),
        "change": q.changes(spark, SF_DIR),
        "edge": view(spark, SF_DIR, "fx_edge"),
    }
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    for name, df in frames.items():
        df.write.parquet(f"{out}/{name}")
    maps, _, keyed = q._tag_frames(spark, SF_DIR)
    maps.write.parquet(f"{out}/tag_map")
    keyed.write.parquet(f"{out}/tag_key")
    q.cost(spark, SF_DIR).withColumn("usage_load_dt", F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{out}/cost")
    gold.billing_cost_fact(read("cost"), read("workspace"), read("resource"), read("identity")).write.parquet(f"{out}/gold")
    groups.closure(read("edge")).write.parquet(f"{out}/closed")
    history = read("change")
    cdc.scd2(history.filter("change_time < timestamp_ntz '2024-01-27 00:00:00'"), q.CHANGE_KEYS, "change_time").write.parquet(f"{out}/history_before")
    return read


def headline(spark, read):
    from costloom.operators.pricing import price_lines

    def rollup():
        priced = price_lines(read("usage"), read("price"), currency="USD")
        return priced.groupBy("usage_dt", "sku_name_lb").agg(F.sum("line_cost_usd").alias("cost"))

    def allocation():
        return costing.query_attribution(read("history"), costing.warehouse_pool(read("billed")))

    def serving():
        return costing.serving_attribution(read("serving"), read("entity"), costing.endpoint_pool(read("billed")))

    def scd2_increment():
        late = read("change").filter("change_time >= timestamp_ntz '2024-01-27 00:00:00'")
        return cdc.scd2_apply(read("history_before"), late, q.CHANGE_KEYS, "change_time")

    def merge_one_percent():
        """One percent of the lines change, spread over all days."""
        cost = read("cost")
        part = cost.filter(F.pmod(F.xxhash64("record_cd"), F.lit(100)) == 0).withColumn(
            "line_cost_usd", (F.coalesce("line_cost_usd", F.lit(0)) + 1).cast("decimal(38,8)"))
        return merge(cost, part, silver.LINE_KEYS, guard=["line_cost_usd", "usage_load_dt"], update=part.columns)

    def merge_one_day():
        """All lines of one ingestion day change; its rows alone are read and merged."""
        day = read("cost").filter("ingestion_dt = date '1995-06-17'")
        part = day.withColumn("line_cost_usd", (F.coalesce("line_cost_usd", F.lit(0)) + 1).cast("decimal(38,8)"))
        return merge(day, part, silver.LINE_KEYS, guard=["line_cost_usd", "usage_load_dt"], update=part.columns)

    def resources():
        """Jobs and clusters are known, other resources are new."""
        snapshot = read("resource").withColumn("region_lb", F.lit("eu"))
        seen = F.lit("2020-01-01").cast("timestamp")
        known = snapshot.filter("resource_type_lb in ('JOB', 'CLUSTER')").withColumns({"sys_create_dt": seen, "sys_update_dt": seen})
        return res.merge_resources(known, snapshot.drop("resource_id"))

    def visible_cost():
        """What one user may see of the cost fact, from the stored factors."""
        facts = read("cost").withColumn("member_cd", F.regexp_replace("run_as_cd", "^user([0-9]+)@x.org$", "c$1"))
        return groups.visible_rows(facts, "member_cd", ["c1"], groups.memberships(read("edge")), read("closed"))

    def visible_pairs():
        """Pairs of the users that a report names, from the stored factors."""
        users = spark.read.parquet(f"{SF_DIR}/customer.parquet").select(F.concat(F.lit("c"), "c_custkey").alias("user_cd"), "c_acctbal")
        return groups.visible_to(users.filter("c_acctbal > 9900"), users, groups.memberships(read("edge")), read("closed"))

    def untagged():
        held = tags.resource_labels(read("tag_map"), read("tag_key"))
        parts = spark.read.parquet(f"{SF_DIR}/part.parquet").select(F.col("p_partkey").alias("resource_id"))
        return tags.untagged_counts(parts, read("tag_key"), tags.label_sets(held))

    def bridge():
        held = tags.resource_labels(read("tag_map"), read("tag_key"))
        parts = spark.read.parquet(f"{SF_DIR}/part.parquet").select(F.col("p_partkey").alias("resource_id"))
        return tags.tag_bridge(parts, read("tag_key"), held)

    def facts():
        return gold.billing_cost_fact(read("cost"), read("workspace"), read("resource"), read("identity"))

    names = ["total_cost", "active_resources", "days_with_cost", "avg_daily_cost", "serverless_cost_pct", "peak_daily_cost"]
    return {
        "line_cost_rollup": rollup,
        "query_allocation": allocation,
        "serving_allocation": serving,
        "scd1": lambda: cdc.scd1(None, read("change"), q.CHANGE_KEYS, "change_time"),
        "scd2_full": lambda: cdc.scd2(read("change"), q.CHANGE_KEYS, "change_time"),
        "scd2_increment": scd2_increment,
        "merge_one_percent": merge_one_percent,
        "merge_one_day": merge_one_day,
        "merge_resources": resources,
        "visibility_of_named_users": visible_pairs,
        "cost_visible_to_user": visible_cost,
        "group_closure": lambda: groups.closure(read("edge")),
        "tag_bridge": bridge,
        "untagged_counts": untagged,
        "gold_billing_cost": facts,
        "monthly_trend": lambda: periods.monthly_trend(read("gold"), "line_cost_usd", ["product_lb"]),
        "cost_measures": lambda: kpi.measure(read("gold"), names, ["product_lb"]),
        "top_resources": lambda: kpi.top(read("gold"), "total_cost", ["resource_id"]),
    }


def run(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    read = stage(spark, f"{ensure_checkpoint_dir(spark)}/bench-{uuid.uuid4().hex}")
    staged = time.perf_counter() - start
    only = sys.argv[1:]
    times = {}
    for name, build in headline(spark, read).items():
        if only and name not in only:
            continue
        run(build)
        times[name] = round(statistics.median(run(build) for _ in range(RUNS)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS), "stage_sec": round(staged, 1)}))


if __name__ == "__main__":
    main()

import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from costloom.operators import cdc, closure as groups, incremental as inc, ranking, tags
from costloom.operators.allocation import allocate, reconcile, statement_weight
from costloom.operators.keys import assign_keys, fill_keys, highest_key, resolve_fk, with_sentinels
from costloom.operators.latest import latest, latest_snapshot
from costloom.operators.merge import align_schemas, merge
from costloom.operators.pricing import price_lines, price_lines_asof, price_overlaps, reprice
from costloom.operators.quality import expect, expectation_report
from costloom.plans import identities as ids, measures as kpi
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def at(n):
    return T0 + dt.timedelta(minutes=n)


# ---- latest, keys ----------------------------------------------------------

def test_latest_keeps_highest_sequence_and_settles_ties(frame):
    df = frame("k string, s int, v string", [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "n"), (None, 1, "q")])
    assert rows(latest(df, ["k"], "s", ["v"])) == rows(frame("k string, s int, v string", [("a", 3, "z"), ("b", None, "n"), (None, 1, "q")]))
    assert ("a", 1, "x") in rows(latest(df, ["k"], "s", keep="first"))
    shuffled = frame("k string, s int, v string", [("a", 3, "z"), ("a", 3, "y")])
    assert rows(latest(shuffled, ["k"], "s")) == rows(latest(shuffled.orderBy("v"), ["k"], "s"))


def test_latest_reduces_before_the_shuffle(frame):
    plan = latest(frame("k string, s int", [("a", 1)]), ["k"], "s")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_accepts_map_columns(frame):
    df = frame("k int, s int, m map<string,string>", [(1, 1, {"a": "b"}), (1, 1, {"a": "c"})])
    assert latest(df, ["k"], "s").count() == 1


def test_latest_snapshot(frame):
    df = frame("run string, v int", [("1", 1), ("2", 2), ("2", 3)])
    assert rows(latest_snapshot(df, "run"), "v") == [(2,), (3,)]


def test_assigned_keys_are_dense_unique_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("code"))
    first = assign_keys(df, ["code"], "key", start=50)
    ids = sorted(r.key for r in first.collect())
    assert ids == list(range(51, 1051))
    again = assign_keys(df.repartition(7), ["code"], "key", start=50)
    assert rows(first) == rows(again)


def test_fill_keys_keeps_existing(frame):
    df = frame("id bigint, code string", [(7, "a"), (None, "b"), (None, "c")])
    out = dict((c, i) for i, c in rows(fill_keys(df, ["code"], "id", 7)))
    assert out["a"] == 7 and sorted([out["b"], out["c"]]) == [8, 9]
    assert highest_key(df, "id") == 7


def test_sentinels_are_added_once(frame):
    dim = frame("id bigint, code string, sys_create_dt timestamp", [(1, "a", T0)])
    seeds = [{"id": -1, "code": "UNK"}, {"id": -2, "code": "UNS"}]
    once = with_sentinels(dim, seeds, "id")
    assert rows(with_sentinels(once, seeds, "id"), "id", "code") == [(-1, "UNK"), (-2, "UNS"), (1, "a")]
    assert once.filter("sys_create_dt is null").count() == 0


def test_resolve_fk_meets_by_one_hash_and_carries_names(spark, frame):
    fact = frame("n int, a string, b string", [(1, "x", "y"), (2, "x", None), (3, "y", "x"), (4, "x", "y")])
    dim = frame("id bigint, a string, b string, name string", [(7, "x", "y", "seven"), (9, "x", "y", "nine"), (-1, None, None, "none"), (5, "x", None, "five")])
    out = resolve_fk(fact, dim, ["a", "b"], "id", -1, carry=["name"], sentinels=[-1])
    assert rows(out, "n", "id", "name") == [(1, 7, "seven"), (2, -1, "none"), (3, -1, "none"), (4, 7, "seven")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = resolve_fk(fact, dim, ["a", "b"], "id", -1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    assert len(joins) == 1 and joins[0].split("SortMergeJoin ")[1].startswith("[__hash")


def test_resolve_fk_falls_back_and_never_multiplies(frame):
    fact = frame("n int, login string", [(1, "a"), (2, "b"), (3, None), (4, "a")])
    dim = frame("id bigint, login string, active int", [(5, "a", 0), (9, "a", 1), (None, "b", 1)])
    out = resolve_fk(fact, dim, ["login"], "id", -1, prefer=["active"])
    assert rows(out, "n", "id") == [(1, 9), (2, -1), (3, -1), (4, 9)]
    assert rows(resolve_fk(fact, dim, ["login"], "id", -1), "n", "id") == [(1, 5), (2, -1), (3, -1), (4, 5)]


# ---- merge -----------------------------------------------------------------

TARGET = [(1, "a", "old", 0), (2, "b", "same", 0), (3, "c", "gone", 0), (4, None, "null key", 0)]


def target(frame):
    return frame("id int, k string, v string, deleted int", TARGET)


def source(frame, data=(("a", "new"), ("b", "same"), ("d", "added"), (None, "null source"))):
    return frame("k string, v string", list(data))


def test_merge_updates_inserts_and_keeps(frame):
    out = merge(target(frame), source(frame), ["k"], guard=["v"], insert={"deleted": 0}, actions=True)
    got = {(r.k, r.v): (r.id, r["__action"]) for r in out.collect()}
    assert got == {
        ("a", "new"): (1, "update"), ("b", "same"): (2, "keep"), ("c", "gone"): (3, "keep"),
        (None, "null key"): (4, "keep"), ("d", "added"): (None, "insert"), (None, "null source"): (None, "insert"),
    }


def test_merge_flags_and_deletes_by_source(frame):
    flagged = merge(target(frame), source(frame), ["k"], guard=["v"], insert={"deleted": 0},
                    by_source={"deleted": 1}, by_source_when=F.col("t.id") < 4)
    assert {r.v: r.deleted for r in flagged.collect()} == {
        "new": 0, "same": 0, "gone": 1, "null key": 0, "added": 0, "null source": 0}
    deleted = merge(target(frame), source(frame), ["k"], by_source="delete")
    assert "gone" not in {r.v for r in deleted.collect()}
    assert {r.v for r in deleted.filter("k = 'a'").collect()} == {"old"}


def test_merge_revives_deleted_rows(frame):
    dim = frame("id int, k string, v string, deleted int", [(1, "a", "x", 1)])
    out = merge(dim, frame("k string, v string", [("a", "x")]), ["k"], guard=["v"],
                also_when=F.col("t.deleted") == 1, update={"v": F.col("s.v"), "deleted": 0})
    assert rows(out) == [(1, "a", "x", 0)]


def test_merge_twice_changes_nothing(frame):
    src = source(frame, [("a", "new"), ("d", "added")])
    once = merge(target(frame), src, ["k"], guard=["v"], insert={"deleted": 0}, by_source={"deleted": 1},
                 by_source_when=F.col("t.deleted") == 0)
    twice = merge(once, src, ["k"], guard=["v"], insert={"deleted": 0}, by_source={"deleted": 1},
                  by_source_when=F.col("t.deleted") == 0, actions=True)
    assert rows(twice.drop("__action")) == rows(once)
    assert {r["__action"] for r in twice.collect()} == {"keep"}


def test_merge_rejects_two_source_rows_for_one_target(frame):
    src = source(frame, [("a", "x"), ("a", "y")])
    with pytest.raises(Exception, match="several source rows"):
        merge(target(frame), src, ["k"], guard=["v"]).collect()
    assert merge(target(frame), source(frame, [("z", "x"), ("z", "y")]), ["k"], guard=["v"]).count() == 6


def test_merge_compares_maps_by_content(frame, spark):
    old = spark.sql("select 1 as k, map('a','1','b','2') as m")
    same = spark.sql("select 1 as k, map('b','2','a','1') as m")
    other = spark.sql("select 1 as k, map('b','2','a','9') as m")
    action = lambda s: merge(old, s, ["k"], guard=["m"], actions=True).first()["__action"]
    assert action(same) == "keep" and action(other) == "update"


def test_merge_evolves_columns_and_structs(spark):
    old = spark.sql("select 1 as k, named_struct('a', 1) as s")
    new = spark.sql("select 2 as k, named_struct('a', 5, 'b', 'x') as s, 'n' as extra")
    out = merge(old, new, ["k"], guard=["s"], update=["s", "extra"], evolve=True)
    got = {r.k: (r.s.a, r.s.b, r.extra) for r in out.collect()}
    assert got == {1: (1, None, None), 2: (5, "x", "n")}
    left, right = align_schemas(old, new)
    assert left.schema == right.schema or left.columns == right.columns


# ---- change data capture ---------------------------------------------------

def feed(frame, data):
    return frame("k string, seq timestamp, v string", data)


def random_feed(n, seed):
    rnd = random.Random(seed)
    return [(f"k{rnd.randrange(4)}", at(i * rnd.choice([1, 90, 2000])), f"v{i}") for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_batch_split_gives_the_same_tables(frame, seed):
    data = random_feed(40, seed)
    whole1 = cdc.scd1(None, feed(frame, data), ["k"], "seq", ["v"])
    whole2 = cdc.scd2(feed(frame, data), ["k"], "seq", ["v"])
    rnd = random.Random(seed)
    rnd.shuffle(data)
    cut = rnd.randrange(5, 35)
    parts = [feed(frame, data[:cut]), feed(frame, data[cut:])]
    split1 = cdc.scd1(cdc.scd1(None, parts[0], ["k"], "seq", ["v"]), parts[1], ["k"], "seq", ["v"])
    split2 = cdc.scd2_apply(cdc.scd2(parts[0], ["k"], "seq", ["v"]), parts[1], ["k"], "seq", ["v"])
    assert rows(split1) == rows(whole1)
    assert rows(split2) == rows(whole2)


def test_scd2_windows_tile_and_end_open(frame):
    out = cdc.scd2(feed(frame, random_feed(60, 9)), ["k"], "seq").collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.valid_from_dt)
        assert [r.is_current_fl for r in versions] == [0] * (len(versions) - 1) + [1]
        assert versions[-1].valid_to_dt is None
        for a, b in zip(versions, versions[1:]):
            assert a.valid_to_dt == b.valid_from_dt


def test_scd2_one_version_per_sequence_and_inclusive_end(frame):
    data = [("a", at(0), "x"), ("a", at(0), "y"), ("a", at(5), "z"), (None, at(1), "n")]
    out = cdc.scd2(feed(frame, data), ["k"], "seq", ["v"], inclusive_end=True)
    assert rows(out, "v", "valid_to_dt", "is_current_fl") == [
        ("y", at(5) - dt.timedelta(microseconds=1), 0), ("z", None, 1)]


def test_scd1_equals_open_rows_of_scd2(frame):
    f = feed(frame, random_feed(50, 4))
    assert rows(cdc.scd1(None, f, ["k"], "seq", ["v"])) == rows(
        cdc.current_of(cdc.scd2(f, ["k"], "seq", ["v"])), "k", "seq", "v")


def test_scd1_keeps_surrogates_and_ignores_late_rows(frame):
    first = cdc.scd1(None, feed(frame, [("a", at(5), "x"), ("b", at(5), "y")]), ["k"], "seq", id_col="id")
    ids = {r.k: r.id for r in first.collect()}
    second = cdc.scd1(first, feed(frame, [("a", at(1), "late"), ("b", at(9), "new"), ("c", at(1), "c")]),
                      ["k"], "seq", id_col="id", next_id=2)
    got = {r.k: (r.id, r.v) for r in second.collect()}
    assert got["a"] == (ids["a"], "x") and got["b"] == (ids["b"], "new") and got["c"] == (3, "c")


def test_scd2_of_a_hot_key_stays_spread(frame, spark):
    """All versions of one key: the lead runs per key and hour, never over the key alone."""
    plan = cdc.scd2(feed(frame, [("a", at(i), "v") for i in range(10)]), ["k"], "seq")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in text


# ---- marks -----------------------------------------------------------------

def test_marks(frame, spark):
    df = frame("v int, load timestamp", [(1, at(1)), (2, at(5))])
    assert inc.high_water_mark(df, "load") == at(5)
    assert inc.high_water_mark(df.limit(0), "load") == inc.EPOCH == inc.high_water_mark(None, "load")
    assert rows(inc.incremental(df, "load", at(1)), "v") == [(2,)]
    marks = frame("table_name string, account_id string, last_processed_dt timestamp, sys_update_dt timestamp", [])
    marks = inc.upsert_mark(marks, "t", inc.next_mark(df, "load", inc.EPOCH))
    marks = inc.upsert_mark(marks, "t", inc.next_mark(df.limit(0), "load", at(5)))
    assert inc.stored_mark(marks, "t") == at(5) and inc.stored_mark(marks, "u") == inc.EPOCH
    assert marks.count() == 1
    assert inc.next_mark_of(df, df.withColumn("load", F.lit(at(9))), "load", inc.EPOCH).first()[0] == at(9)


# ---- pricing ---------------------------------------------------------------

PRICE = "account_cd string, sku_name_lb string, cloud_lb string, currency_code_lb string, price_start_dt timestamp, price_end_dt timestamp, default_price_nb double, effective_list_price_nb double"


def prices(frame):
    return frame(PRICE, [
        ("a", "s", "AWS", "USD", at(10), at(20), 1.0, None),
        ("a", "s", "AWS", "USD", at(20), None, 2.0, 3.0),
        ("a", "s", "AWS", "EUR", at(10), None, 100.0, None),
    ])


def test_price_windows_are_half_open(frame):
    usage = frame("record_cd string, account_cd string, sku_name_lb string, cloud_lb string, usage_end_dt timestamp, usage_quantity_nb double", [
        ("before", "a", "s", "AWS", at(9), 2.0), ("start", "a", "s", "AWS", at(10), 2.0), ("edge", "a", "s", "AWS", at(20), 2.0),
        ("open", "a", "s", "AWS", at(9999), 2.0), ("cloud", "a", "s", "GCP", at(15), 2.0), ("null", None, "s", "AWS", at(15), 2.0)])
    out = price_lines(usage, prices(frame), currency="USD")
    assert {r.record_cd: r.line_cost_usd for r in out.collect()} == {
        "before": None, "start": 2.0, "edge": 6.0, "open": 6.0, "cloud": None, "null": None}
    corrected = prices(frame).withColumn("default_price_nb", F.lit(7.0))
    changed = corrected.filter("currency_code_lb = 'USD' and price_end_dt is not null")
    assert rows(reprice(out, corrected, changed, currency="USD"), "record_cd", "line_cost_usd") == [("start", 14.0)]


def test_price_overlaps(frame):
    assert price_overlaps(prices(frame).filter("currency_code_lb = 'USD'")).count() == 0
    assert price_overlaps(prices(frame)).count() == 2


def test_asof_price_equals_the_window_join(frame):
    """Gaps, open ends, many windows, slices without a start of their own, and odd lines."""
    rnd = random.Random(4)
    day = lambda n: T0 + dt.timedelta(days=n, minutes=rnd.randrange(3))
    windows = []
    for sku in "abc":
        starts = sorted(rnd.sample(range(400), 120))
        for n, (s, e) in enumerate(zip(starts, [*starts[1:], None])):
            until = None if e is None else T0 + dt.timedelta(days=rnd.choice([e, max(s + 1, e - 2)]))
            windows.append(("x", sku, "AWS", "USD", T0 + dt.timedelta(days=s), until, float(n), None if n % 3 else n / 2))
    usage = [(i, rnd.choice("xxxy"), rnd.choice("abcd"), "AWS", day(rnd.randrange(-9, 600)), float(i)) for i in range(500)]
    usage += [(500 + i, None, "a", "AWS", day(5), 1.0) for i in range(3)] + [(510, "x", "a", "AWS", None, 1.0), (511, "x", "a", None, day(4), 1.0)]
    usage += [(512, "x", "a", "AWS", T0 + dt.timedelta(days=60), None)] * 2
    df = frame("id int, account_cd string, sku_name_lb string, cloud_lb string, usage_end_dt timestamp, usage_quantity_nb double", usage)
    p = frame(PRICE, windows)
    assert price_overlaps(p).count() == 0
    want = rows(price_lines(df, p, currency="USD"))
    for options in ({}, {"slice_days": 1, "lanes": 1}, {"slice_days": 1000, "lanes": 3}):
        assert rows(price_lines_asof(df, p, currency="USD", **options)) == want
    assert rows(price_lines_asof(df, p.limit(0)), "id", "line_cost_usd") == sorted(((u[0], None) for u in usage), key=repr)
    assert price_lines_asof(df.limit(0), p).count() == 0


def test_asof_price_deals_a_hot_sku_to_several_tasks(spark):
    lines = spark.range(4000).select("id", F.lit("s").alias("sku"), F.lit(T0).alias("at"), F.lit(1.0).alias("w"))
    p = spark.range(1).select(F.lit("s").alias("sku"), F.lit(T0).alias("price_start_dt"), F.lit(None).cast("timestamp").alias("price_end_dt"),
                              F.lit(1.0).alias("default_price_nb"), F.lit(2.0).alias("effective_list_price_nb"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = price_lines_asof(lines, p, on=["sku"], at="at", quantity="w").withColumn("part", F.spark_partition_id())
        per = [r[1] for r in out.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(per) == 4000 and len(per) >= 5 and max(per) < 2000


# ---- allocation ------------------------------------------------------------

def items(frame):
    return frame("n int, day date, wh string, w bigint, cached int", [
        (1, T0.date(), "a", 30, 0), (2, T0.date(), "a", 10, 0), (3, T0.date(), "a", 0, 1),
        (4, T0.date(), "b", 0, 1), (5, T0.date(), "nopool", 5, 0), (6, None, "a", 5, 0)])


def pool(frame):
    return frame("day date, wh string, pool_cost_usd double", [
        (T0.date(), "a", 100.0), (T0.date(), "b", 50.0), (T0.date(), "idle", 9.0)])


def test_allocation_edges(frame):
    out = allocate(items(frame), pool(frame), ["day", "wh"], "w", exempt=F.col("cached") == 1)
    assert {r.n: r.attributed_cost_usd for r in out.collect()} == {1: 75.0, 2: 25.0, 3: 0.0, 4: 0.0, 5: None}
    even = allocate(items(frame), pool(frame), ["day", "wh"], "w", even_split=True, no_pool=0, count_as="n_nb")
    got = {r.n: (r.attributed_cost_usd, r.n_nb) for r in even.collect()}
    assert got == {1: (75.0, 3), 2: (25.0, 3), 3: (0.0, 3), 4: (50.0, 1), 5: (0.0, 1)}


def test_allocation_conserves_the_pool_and_reconciles(frame, spark):
    rnd = random.Random(5)
    data = [(i, T0.date(), f"w{rnd.randrange(5)}", rnd.randrange(1, 1000), 0) for i in range(500)]
    it = frame("n int, day date, wh string, w bigint, cached int", data)
    p = frame("day date, wh string, pool_cost_usd double", [(T0.date(), f"w{i}", 10.0 * (i + 1)) for i in range(6)])
    out = allocate(it, p, ["day", "wh"], "w")
    rec = {r.wh: r for r in reconcile(out, p, ["day", "wh"]).collect()}
    for i in range(5):
        assert abs(rec[f"w{i}"].residual_usd) <= 500 * 5e-7
    assert rec["w5"].items_nb == 0 and rec["w5"].residual_usd == 60.0


def test_statement_weight(frame):
    df = frame("c int, t bigint, q bigint", [(1, 9, 0), (0, 9, None), (0, 9, 4), (0, 3, 10), (0, None, 1)])
    assert [r[0] for r in df.select(statement_weight("c", "t", "q")).collect()] == [0, 9, 5, 1, 1]


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.shuffle.partitions": "20",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def hot_rows(spark):
    """A third of the rows, and more, share one key."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    return spark.range(0, 200000, 1, 16).select(
        "id", F.lit(T0.date()).alias("day"), hot.cast("string").alias("wh"), (F.col("id") % 7 + 1).alias("w"))


def hot_allocation(spark):
    p = spark.range(500).select(F.lit(T0.date()).alias("day"), F.col("id").cast("string").alias("wh"),
                                F.lit(100.0).alias("pool_cost_usd"))
    return allocate(hot_rows(spark), p, ["day", "wh"], "w")


def hot_dimension(spark):
    return spark.range(1000).select((F.col("id") + 1).alias("key"), (F.col("id") % 500).cast("string").alias("wh"),
                                    (F.col("id") % 2).alias("active"))


def hot_price(spark):
    usage = hot_rows(spark).select("id", F.col("wh").alias("sku"), F.col("day").cast("timestamp").alias("at"), "w")
    p = spark.range(500).select(F.col("id").cast("string").alias("sku"), F.lit(T0).alias("price_start_dt"), F.lit(None).cast("timestamp").alias("price_end_dt"),
                                F.lit(1.0).alias("default_price_nb"), F.lit(2.0).alias("effective_list_price_nb"))
    return price_lines(usage, p, on=["sku"], at="at", quantity="w")


HOT = {
    "allocation": hot_allocation,
    "surrogate": lambda spark: resolve_fk(hot_rows(spark), hot_dimension(spark), ["wh"], "key", -1),
    "preferred surrogate": lambda spark: resolve_fk(hot_rows(spark), hot_dimension(spark), ["wh"], "key", -1, prefer=["active"]),
    "price": hot_price,
}


@pytest.mark.parametrize("name", HOT)
def test_hot_keys_are_split(spark, name):
    """Adaptive execution splits the partition of the hot key."""
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        out = HOT[name](spark)
        assert len(out.collect()) == 200000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- tags ------------------------------------------------------------------

def test_tag_variants_share_one_key(frame):
    maps = frame("resource_id bigint, tags map<string,string>", [
        (1, {"app_id": "A1", "team": "x"}), (2, {" App_Id": "A2"}), (3, {"APP_ID": "A3", "app_id": "A4"}), (4, {"Team": None})])
    keys = tags.tag_keys(maps)
    assert rows(keys, "tag_key_cd", "raw_key_lb") == [("AppId", "APP_ID"), ("Team", "Team")]
    keyed = keys.withColumn("tag_key_id", F.when(F.col("tag_key_cd") == "AppId", 1).otherwise(2).cast("bigint"))
    held = tags.resource_labels(maps, keyed)
    grid = tags.tag_bridge(frame("resource_id bigint", [(1,), (2,), (3,), (4,), (5,), (-1,)]), keyed, held)
    assert rows(grid) == [(1, 1, "A1"), (1, 2, "x"), (2, 1, "A2"), (2, 2, "Untagged"), (3, 1, "A3"), (3, 2, "Untagged"),
                          (4, 1, "Untagged"), (4, 2, "Untagged"), (5, 1, "Untagged"), (5, 2, "Untagged")]
    exact = tags.resource_labels(maps, keyed, exact_spelling=True)
    assert rows(exact) == [(3, 1, "A3"), (4, 2, None)]


def test_bridge_needs_no_cartesian_product(frame):
    keyed = frame("tag_key_id bigint, tag_key_cd string, raw_key_lb string", [(1, "AppId", "app_id")])
    held = frame("resource_id bigint, tag_key_id bigint, tag_value_lb string", [(1, 1, "A1")])
    plan = tags.tag_bridge(frame("resource_id bigint", [(1,), (2,)]), keyed, held)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_untagged_by_complement_equals_the_grid(frame):
    rnd = random.Random(6)
    ids = [i for i in range(1, 70_000, 97)] + [32_768, 32_769, 65_536, 65_537]
    resources = frame("resource_id bigint", [(i,) for i in {*ids, -3, 0}])
    keys = frame("tag_key_id bigint", [(1,), (2,), (3,), (-1,)])
    held = sorted({(i, k): (i, k, rnd.choice("xyz")) for i in ids for k in (1, 2) if rnd.random() < 0.4}.values())
    carried = frame("resource_id bigint, tag_key_id bigint, tag_value_lb string", held)
    sets = tags.label_sets(carried)
    grid = tags.tag_bridge(resources, keys, carried)
    counts = grid.groupBy("tag_key_id").agg(F.count_if(F.col("tag_value_lb") != tags.UNTAGGED), F.count_if(F.col("tag_value_lb") == tags.UNTAGGED))
    assert rows(tags.untagged_counts(resources, keys, sets)) == rows(counts)
    assert rows(tags.untagged_counts(resources, keys, sets.limit(0)), "tagged_nb", "untagged_nb") == [(0, len(set(ids)))] * 3
    for labels in ([1], [1, 2], [3]):
        lacking = {i for i in ids if not any((i, k) in {h[:2] for h in held} for k in labels)}
        assert rows(tags.without_labels(resources, sets, labels)) == sorted(((i,) for i in lacking), key=repr)
    cost = frame("resource_id bigint, day int, line_cost_usd bigint", [
        (rnd.choice([*ids[:200], -3, 99_999_999]), rnd.randrange(3), rnd.randrange(100)) for _ in range(900)])
    for by in ([], ["day"]):
        cell = ["tag_key_id", "tag_value_lb", *by]
        want = grid.join(cost, "resource_id").groupBy(*cell).agg(
            F.countDistinct("resource_id").alias("resources_nb"), F.sum("line_cost_usd").alias("total_cost"))
        got = tags.cost_by_tag(cost, resources, keys, carried, by=by)
        assert rows(got, *cell, "resources_nb", "total_cost") == rows(want, *cell, "resources_nb", "total_cost")


def test_untagged_by_complement_makes_no_grid(frame):
    held = frame("resource_id bigint, tag_key_id bigint, tag_value_lb string", [(1, 1, "a")])
    parts, keys = frame("resource_id bigint", [(1,), (2,)]), frame("tag_key_id bigint", [(1,)])
    plan = tags.untagged_counts(parts, keys, tags.label_sets(held))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


# ---- closure ---------------------------------------------------------------

EDGE = "group_cd string, member_cd string, member_type_lb string"


def brute_closure(edges):
    nest, leaf = {}, {}
    for g, m, t in edges:
        (nest if t == "Groups" else leaf).setdefault(g, set()).add(m)
    out = set()
    for g in {e[0] for e in edges}:
        seen, todo = set(), [g]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += nest.get(x, [])
        out |= {(g, m) for x in seen for m in leaf.get(x, [])}
    return sorted(out)


def test_closure_with_cycles_and_diamonds(frame):
    rnd = random.Random(3)
    edges = [(f"g{rnd.randrange(12)}", f"g{rnd.randrange(12)}", "Groups") for _ in range(20)]
    edges += [(f"g{rnd.randrange(12)}", f"u{rnd.randrange(9)}", "Users") for _ in range(15)]
    edges += [("g1", "s1", "ServicePrincipals")]
    df = frame(EDGE, edges)
    assert rows(groups.closure(df)) == brute_closure(edges)
    assert rows(groups.closure(df.orderBy(F.rand(1)))) == brute_closure(edges)


def test_closure_of_deep_nesting(frame):
    edges = [(f"g{i}", f"g{i+1}", "Groups") for i in range(150)] + [("g150", "u", "Users")]
    out = groups.closure(frame(EDGE, edges))
    assert out.count() == 151 and ("g0", "u") in rows(out)


def test_visibility_and_deleted_edges(frame):
    df = frame(EDGE + ", is_deleted_fl int", [("g", "u1", "Users", 0), ("g", "h", "Groups", 0), ("h", "u2", "Users", 0), ("h", "u3", "Users", 1)])
    users = frame("user_cd string", [("u1",), ("u9",)])
    out = groups.visibility(users, df, groups.closure(df))
    assert rows(out) == [("u1", "u1"), ("u1", "u2"), ("u2", "u2"), ("u9", "u9")]


def random_edges(rnd, groups_nb, nest, leaf):
    edges = {(f"g{rnd.randrange(groups_nb)}", f"g{rnd.randrange(groups_nb)}", "Groups") for _ in range(nest)}
    return edges | {(f"g{rnd.randrange(groups_nb)}", f"u{rnd.randrange(9)}", "Users") for _ in range(leaf)}


@pytest.mark.parametrize("seed", range(2))
def test_closure_under_change_equals_closure_from_scratch(frame, seed):
    """Two days of added and ended edges, with cycles and paths that end."""
    rnd = random.Random(seed)
    now = random_edges(rnd, 14, 16, 14)
    reach, closed = groups.reachable_groups(frame(EDGE, sorted(now))), groups.closure(frame(EDGE, sorted(now)))
    for _ in range(2):
        then = {e for e in now if rnd.random() < 0.75} | random_edges(rnd, 16, 5, 4)
        before, after = frame(EDGE, sorted(now)), frame(EDGE, sorted(then))
        changed = groups.changed_edges(before, after)
        assert set(rows(changed)) == now ^ then
        reach, touched = groups.reach_apply(reach, after, changed)
        reach = reach.checkpoint()
        closed = groups.closure_apply(closed, reach, after, changed, touched).checkpoint()
        assert rows(reach) == rows(groups.reachable_groups(after))
        assert rows(closed) == brute_closure(then)
        now = then


def test_a_cut_chain_and_a_new_link(frame):
    chain = [(f"g{i}", f"g{i+1}", "Groups") for i in range(40)] + [("g40", "u", "Users")]
    cut = [e for e in chain if e[0] != "g20"] + [("g30", "g5", "Groups"), ("g5", "v", "Users")]
    before, after = frame(EDGE, chain), frame(EDGE, cut)
    changed = groups.changed_edges(before, after)
    reach, touched = groups.reach_apply(groups.reachable_groups(before), after, changed)
    assert rows(groups.closure_apply(groups.closure(before), reach, after, changed, touched)) == brute_closure(cut)
    assert touched.count() == 31  # groups above the cut or above the new link


def test_nothing_changed_touches_nothing(frame):
    df = frame(EDGE, [("g", "h", "Groups"), ("h", "u", "Users")])
    changed = groups.changed_edges(df, df.unionAll(df))
    reach, touched = groups.reach_apply(groups.reachable_groups(df), df, changed)
    assert changed.isEmpty() and touched.isEmpty() and rows(reach) == [("g", "g"), ("g", "h"), ("h", "h")]


def test_visibility_from_factors(frame):
    rnd = random.Random(5)
    edges = sorted(random_edges(rnd, 6, 7, 20))
    df = frame(EDGE, edges)
    users, closed, own = frame("user_cd string", [(f"u{i}",) for i in range(10)]), groups.closure(df), groups.memberships(df)
    every = rows(groups.visibility(users, df, closed))
    assert rows(groups.visible_to(users, users, own, closed)) == [p for p in every if p[0] in {f"u{i}" for i in range(10)}]
    asked = frame("user_cd string", [("u3",), ("u3",), ("u9",), ("nobody",)])
    assert rows(groups.visible_to(asked, users, own, closed)) == [p for p in every if p[0] in ("u3", "u9")]
    facts = frame("who string, n int", [(f"u{i}", i) for i in range(10)] + [("u1", 11), (None, 12)])
    for u in ("u1", "u9"):
        want = sorted(((f"u{i}", n) for i in range(10) for n in ((i, 11) if i == 1 else (i,)) if (u, f"u{i}") in every), key=repr)
        assert rows(groups.visible_rows(facts, "who", [u], own, closed)) == want


# ---- ranking ---------------------------------------------------------------

@pytest.mark.parametrize("dense", [True, False])
def test_ranks_match_brute_force(frame, dense):
    rnd = random.Random(8)
    data = [(f"n{i}", float(rnd.randrange(40)) if i % 9 else None) for i in range(200)]
    values = sorted((v for _, v in data if v is not None), reverse=True)
    distinct = sorted(set(values), reverse=True)
    rank = (lambda v: distinct.index(v) + 1) if dense else (lambda v: values.index(v) + 1)
    want = {n: rank(v) for n, v in data if v is not None}
    df = frame("n string, v double", data)
    top = {r.n: r.rank_nb for r in ranking.top_n(df, "v", 10, dense).collect()}
    assert top == {n: r for n, r in want.items() if r <= 10}
    everyone = {r.n: r.rank_nb for r in ranking.global_rank(df, "v", dense, cuts=7).collect() if r.v is not None}
    assert everyone == want


@pytest.mark.parametrize("p", [0.0, 0.5, 0.9, 1.0])
def test_percentile_is_exact(frame, p):
    rnd = random.Random(1)
    data = [(f"g{i % 3}", rnd.choice([0, -5, 7, rnd.randrange(-10**6, 10**6), rnd.randrange(10**15)])) for i in range(600)]
    df = frame("g string, v bigint", data + [("g0", None)])
    got = {r.g: r.x for r in ranking.percentile_inc(df, "v", p, ["g"], "x").collect()}
    for g in got:
        assert got[g] == pytest.approx(np.percentile([v for k, v in data if k == g], p * 100), rel=1e-12, abs=1e-6)
    total = ranking.percentile_inc(df, "v", p, out="x").first().x
    assert total == pytest.approx(np.percentile([v for _, v in data], p * 100), rel=1e-12, abs=1e-6)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.9, 1.0])
def test_percentile_keeps_fractions(frame, p):
    rnd = random.Random(2)
    data = [rnd.choice([0.25, -0.75, rnd.uniform(-3, 3), rnd.uniform(-1e12, 1e12)]) for _ in range(500)]
    got = ranking.percentile_inc(frame("v double", [(v,) for v in data]), "v", p, out="x").first().x
    assert got == pytest.approx(np.percentile(data, p * 100), rel=1e-12, abs=1e-9)


def test_share(frame):
    df = frame("g string, n string, v double", [("a", "x", 1.0), ("a", "y", 3.0), (None, "z", 0.0)])
    assert rows(ranking.share(df, "v", ["g"]), "n", "share_nb") == [("x", 0.25), ("y", 0.75), ("z", None)]
    assert rows(ranking.share(df, "v"), "n", "share_nb") == [("x", 0.25), ("y", 0.75), ("z", 0.0)]


def test_keyed_merge_joins_whole_rows_once(spark):
    from checks import queries as q

    plan = q.QUERIES["merge_resources"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1


# ---- expectations ----------------------------------------------------------

def test_expectations_count_and_keep(frame):
    df = frame("a int", [(1,), (None,), (-1,)])
    kept, seen = expect(df, {"a not null": "a is not null", "a positive": F.col("a") > 0})
    assert kept.count() == 3
    assert seen.get == {"rows": 3, "a not null": 1, "a positive": 2}
    assert rows(expectation_report(df, {"a positive": "a > 0"})) == [("a positive", 3, 2)]


def _company(frame, n=90):
    """Two nested groups of many users, one user in both, a NULL user, a NULL member and a user without a group."""
    edges = [("top", "low", "Groups")] + [("low" if i % 3 else "top", f"u{i}", "Users") for i in range(n)]
    edges += [("low", "u0", "Users"), ("low", None, "Users"), ("top", None, "ServicePrincipals"), (None, "u1", "Users")]
    df = frame("group_cd string, member_cd string, member_type_lb string", edges)
    return df, frame("user_cd string", [(f"u{i}",) for i in range(n)] + [("alone",), ("alone",), (None,)])


def _plainly(users, edges, closed):
    own = groups.memberships(edges)
    return own.join(closed, "group_cd").select("user_cd", "member_cd").union(users.selectExpr("user_cd", "user_cd")).distinct()


def test_visible_pairs_are_neither_shuffled_nor_made_distinct(frame, monkeypatch):
    monkeypatch.setattr(groups, "BLOCK", 16)
    df, users = _company(frame)
    closed = groups.closure(df).checkpoint()
    out, want = groups.visibility(users, df, closed), _plainly(users, df, closed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Aggregate" in x and "user_cd" in x.partition("functions")[0] and "member_cd" in x.partition("functions")[0]]
    assert out.count() == want.count() and not out.exceptAll(want).count()


def test_pairs_are_handed_on_a_few_users_at_a_time(frame, monkeypatch):
    monkeypatch.setattr(groups, "BLOCK", 16)
    monkeypatch.setattr(groups, "USERS_AT_ONCE", 3)
    df, users = _company(frame)
    closed = groups.closure(df).checkpoint()
    out, want = groups.visibility(users, df, closed), _plainly(users, df, closed)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    step = lambda word: next(i for i, x in enumerate(plan) if word in x)
    assert step("Generate inline") < step("Coalesce") < step("slice(")
    assert out.count() == want.count() and not out.exceptAll(want).count() and not want.exceptAll(out).count()


def test_visibility_is_merged_without_meeting_the_pairs(frame, monkeypatch):
    monkeypatch.setattr(groups, "BLOCK", 16)
    df, users = _company(frame)
    closed = groups.closure(df).checkpoint()
    old = dt.datetime(2020, 1, 1)
    known = [("u0", "u1"), ("u0", "u1"), ("alone", "alone"), ("u4", "gone"), (None, "u1"), (None, None)] + [(f"u{i}", f"u{i + 1}") for i in range(0, 80, 2)]
    bridge = frame("user_cd string, member_cd string, sys_create_dt timestamp, note string", [(*k, old, "n") for k in known])
    bridge = bridge.select("user_cd", "member_cd", "sys_create_dt", F.col("sys_create_dt").alias("sys_update_dt"), "note")
    told = lambda d: d.selectExpr("user_cd", "member_cd", "note", "year(sys_create_dt) > 2020 as new", "year(sys_update_dt) > 2020 as fresh")
    out = ids.merge_visible(bridge, users, df, closed)
    want = ids.merge_visibility(bridge, _plainly(users, df, closed))
    assert out.schema.simpleString() == want.schema.simpleString()
    assert not told(out).exceptAll(told(want)).count() and not told(want).exceptAll(told(out)).count()


def test_merge_shuffles_only_what_is_read(frame):
    target = frame("k int, v int, wide string", [(1, 1, "a"), (2, 2, "b"), (None, 3, "c")])
    source = frame("k int, v int, wide string", [(1, 5, "x"), (4, 4, "y"), (None, 3, "z")])
    out = merge(target, source, ["k"], guard=["v"], update=["v", "wide"], actions=True)
    assert rows(out) == sorted([(1, 5, "x", "update"), (2, 2, "b", "keep"), (None, 3, "c", "keep"), (4, 4, "y", "insert"), (None, 3, "z", "insert")], key=repr)
    plan = out.select("k", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Project" in x and "wide" in re.sub(r"xxhash64\([^)]*\)", "", x)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_merge_shuffles_each_side_once_and_its_keys_once(frame, monkeypatch, null_safe):
    shape = "a string, b string, d date, v int"
    day = dt.date(2024, 1, 1)
    target = frame(shape, [("x", "y", day, 1), ("xy", "", day, 1), (None, "n", day, 1), ("x", "z", None, 1)])
    source = frame(shape, [("x", "y", day, 2), ("xy", "", day, 1), (None, "n", day, 2), ("q", None, None, 2), ("x", "z", day, 2)])
    out = merge(target, source, ["a", "b", "d"], guard=["v"], actions=True, null_safe=null_safe)
    met = [(None, "n", day, 2, "update")] if null_safe else [(None, "n", day, 1, "keep"), (None, "n", day, 2, "insert")]
    want = [("x", "y", day, 2, "update"), ("xy", "", day, 1, "keep"), ("x", "z", None, 1, "keep"), ("q", None, None, 2, "insert"),
            ("x", "z", day, 2, "insert"), *met]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert rows(out) == sorted(want, key=repr)
    assert len(re.findall(r"Exchange hashpartitioning\(__\w_lane#\d+L, \d+\)", plan)) == len(re.findall("Exchange", plan)) == 2
    assert re.search(r"SortMergeJoin \[__t_lane#\d+L\], \[__s_lane#\d+L\], FullOuter", plan)
    # Keys that only share their hash neither match nor count as doubled.
    monkeypatch.setattr("costloom.operators.merge.F.xxhash64", lambda *c: F.lit(7).cast("bigint"))
    assert rows(merge(target, source, ["a", "b", "d"], guard=["v"], actions=True, null_safe=null_safe)) == rows(out)
    with pytest.raises(Exception, match="several source rows"):
        merge(target, source.unionByName(source), ["a", "b", "d"], guard=["v"], null_safe=null_safe).collect()


def test_merge_of_other_key_types(frame):
    target = frame("k int, x double, v int", [(1, 0.0, 1), (2, None, 1)])
    source = frame("k bigint, x double, v int", [(1, -0.0, 2), (2, None, 2)])
    assert sorted(r.v for r in merge(target, source, ["k", "x"], guard=["v"], null_safe=True).collect()) == [2, 2]
    assert sorted(r.v for r in merge(target, source, ["k", "x"], guard=["v"]).collect()) == [1, 2, 2]


def test_prices_as_of_shuffle_only_what_is_read(frame):
    when = lambda m: dt.datetime(2024, m, 1)
    usage = frame("sku string, at timestamp, qty int, wide string, n int", [("a", when(2), 2, "w", 1), ("a", None, 2, "w", 2), ("b", when(2), 3, "w", 3)])
    prices = frame("sku string, price_start_dt timestamp, price_end_dt timestamp, effective_list_price_nb int, default_price_nb int, currency_code_lb string",
                   [("a", when(1), when(3), None, 5, "USD")])
    out = price_lines_asof(usage, prices, on=["sku"], at="at", quantity="qty")
    assert out.columns == [*usage.columns, "line_cost_usd"]
    assert rows(out, "sku", "n", "line_cost_usd", "wide") == sorted([("a", 1, 10, "w"), ("a", 2, None, "w"), ("b", 3, None, "w")], key=repr)
    few = out.select("sku", "line_cost_usd")._jdf.queryExecution().executedPlan().toString()
    window = next(x for x in few.splitlines() if "Window" in x and "__lane" in x)
    assert "wide" not in window and not [x for x in few.splitlines() if "Sort" in x and "__k" in x] and "__line." not in few


def test_ranks_and_shares_compute_the_measure_once(frame):
    fact = frame("g string, line_cost_usd int", [("a", 3), ("b", 5), (None, 5)])
    for out in (kpi.ranked(fact, "total_cost", ["g"]), kpi.top(fact, "total_cost", ["g"]), kpi.cost_share(fact, ["g"])):
        assert "line_cost_usd" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert rows(kpi.ranked(fact, "total_cost", ["g"])) == sorted([("a", 3, 2), ("b", 5, 1), (None, 5, 1)], key=repr)

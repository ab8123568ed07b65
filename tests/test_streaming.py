import datetime as dt

import pytest
from pyspark.sql import functions as F

from costloom.operators import cdc
from costloom.sources import directory, lookups
from costloom.sources.tables import Tables
from costloom.streaming import flows
from costloom.streaming.ingest import (
    extract, extract_snapshot, ingest, ingest_all, landed_schema, read_appended, run_all,
)
from costloom.operators.latest import latest_snapshot
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
FEED = "k string, seq timestamp, v string"


def feed_rows(n):
    return [(f"k{i % 5}", T0 + dt.timedelta(minutes=(i * 37) % 500), f"v{i}") for i in range(n)]


def write(frame, path, data, schema=FEED):
    frame(schema, data).coalesce(1).write.mode("overwrite").parquet(path)


def test_ingest_reads_subfolders_once_and_adds_lineage(spark, frame, tmp_path):
    src, out, check = f"{tmp_path}/raw", f"{tmp_path}/sal", f"{tmp_path}/check"
    write(frame, f"{src}/ws1", feed_rows(10))
    write(frame, f"{src}/ws2/deep", feed_rows(5))
    run_all({"t": ingest(spark, src, out, check)})
    run_all({"t": ingest(spark, src, out, check)})
    got = spark.read.parquet(out)
    assert got.count() == 15
    assert {"_source_file_name", "_source_file_dt", "sal_load_dt"} <= set(got.columns)
    assert got.filter("_source_file_name is null or sal_load_dt is null").count() == 0
    write(frame, f"{src}/ws3", feed_rows(2))
    run_all({"t": ingest(spark, src, out, check)})
    assert spark.read.parquet(out).count() == 17


def test_ingest_adds_columns_that_appear_later(spark, frame, tmp_path):
    src, out, check = f"{tmp_path}/raw", f"{tmp_path}/sal", f"{tmp_path}/check"
    write(frame, f"{src}/a", [("x", 1)], "k string, n int")
    stored = landed_schema(spark, src)
    run_all({"t": ingest(spark, src, out, check, stored)})
    write(frame, f"{src}/b", [("y", "new")], "k string, extra string")
    wide = landed_schema(spark, f"{src}/b", stored)
    assert wide.fieldNames() == ["k", "n", "extra"]
    run_all({"t": ingest(spark, src, out, check, wide)})
    got = spark.read.schema(wide).parquet(out)
    assert rows(got) == [("x", 1, None), ("y", None, "new")]


def test_ingest_all_and_failures_are_reported_together(spark, frame, tmp_path):
    for name in ("one", "two"):
        write(frame, f"{tmp_path}/raw/{name}/ws", feed_rows(3))
    started = ingest_all(spark, f"{tmp_path}/raw", f"{tmp_path}/sal", f"{tmp_path}/check", {"one": "sal_one", "two": "sal_two"})
    run_all(started)
    assert spark.read.parquet(f"{tmp_path}/sal/sal_two").count() == 3

    def boom(batch, batch_id):
        raise ValueError("broken sink")

    source = read_appended(spark, f"{tmp_path}/raw/one", FEED)
    bad = source.writeStream.foreachBatch(boom).option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    good = extract(source, f"{tmp_path}/out", f"{tmp_path}/c2")
    with pytest.raises(RuntimeError, match="1 stream\\(s\\) failed: bad"):
        run_all({"bad": bad, "good": good})
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out").count() == 3


def test_extract_skips_empty_batches_and_is_incremental(spark, frame, tmp_path):
    src, out, check = f"{tmp_path}/src", f"{tmp_path}/out", f"{tmp_path}/check"
    write(frame, f"{src}/a", feed_rows(4))
    stream = lambda: read_appended(spark, src, FEED)
    run_all({"x": extract(stream(), out, check)})
    write(frame, f"{src}/b", feed_rows(3))
    run_all({"x": extract(stream(), out, check)})
    run_all({"x": extract(stream(), out, check)})
    assert spark.read.option("recursiveFileLookup", "true").parquet(out).count() == 7


def test_snapshot_extract(spark, frame, tmp_path):
    df = frame("k string", [("a",), ("b",)])
    extract_snapshot(df, f"{tmp_path}/s", "2024-01-01")
    extract_snapshot(df.limit(1), f"{tmp_path}/s", "2024-01-02")
    assert extract_snapshot(df.limit(0), f"{tmp_path}/s", "2024-01-03") is None
    all_runs = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/s")
    assert latest_snapshot(all_runs, "snapshot_run").count() == 1


@pytest.mark.parametrize("pieces", [1, 3])
def test_cdc_flows_equal_the_batch_form(spark, frame, tmp_path, pieces):
    data = feed_rows(30)
    src = f"{tmp_path}/src"
    tables = Tables(spark, f"{tmp_path}/tables")
    schema = frame(FEED, []).schema
    for i in range(pieces):
        write(frame, f"{src}/p{i}", data[i::pieces])
        stream = read_appended(spark, src, schema)
        run_all({
            "now": flows.scd1_flow(stream, tables, "now", ["k"], "seq", f"{tmp_path}/c1", ["v"], "id"),
            "past": flows.scd2_flow(stream, tables, "past", ["k"], "seq", f"{tmp_path}/c2", ["v"]),
            "days": flows.scd1_by_day_flow(stream.withColumn("day", F.to_date("seq")), tables, "days", ["k", "day"], "seq", "day",
                                           f"{tmp_path}/c3", ["v"]),
        })
    whole = frame(FEED, data)
    assert rows(tables.read("now"), "k", "seq", "v") == rows(cdc.scd1(None, whole, ["k"], "seq", ["v"]))
    assert sorted(r.id for r in tables.read("now").collect()) == [1, 2, 3, 4, 5]
    assert rows(tables.read("past")) == rows(cdc.scd2(whole, ["k"], "seq", ["v"]))
    by_day = cdc.scd1(None, whole.withColumn("day", F.to_date("seq")), ["k", "day"], "seq", ["v"])
    assert rows(tables.read("days"), "k", "day", "v") == rows(by_day, "k", "day", "v")


def test_a_replayed_batch_changes_nothing(spark, frame, tmp_path):
    """Versions are there but the checkpoint was lost after the write: same batch again."""
    src = f"{tmp_path}/src"
    tables = Tables(spark, f"{tmp_path}/tables")
    write(frame, f"{src}/a", feed_rows(10))
    stream = lambda: read_appended(spark, src, FEED)
    run_all({"t": flows.scd1_flow(stream(), tables, "t", ["k"], "seq", f"{tmp_path}/c1", ["v"], "id")})
    before = rows(tables.read("t"))
    run_all({"t": flows.scd1_flow(stream(), tables, "t", ["k"], "seq", f"{tmp_path}/c1-again", ["v"], "id")})
    assert rows(tables.read("t")) == before and tables.versions("t") == [1]


def test_an_unfinished_version_is_not_current(spark, frame, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.replace("t", frame("a int", [(1,)]))
    frame("a int", [(2,)]).write.parquet(f"{tmp_path}/t/version-00000002")
    (tmp_path / "t" / "version-00000002" / "_SUCCESS").unlink()
    assert rows(tables.read("t")) == [(1,)]
    tables.replace("t", frame("a int", [(3,)]))
    assert rows(tables.read("t")) == [(3,)]


def test_daily_table_replaces_only_touched_days_and_widens(spark, frame, tmp_path):
    tables = Tables(spark, str(tmp_path))
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tables.overwrite_days("f", frame("v int, day date", [(1, d1), (2, d2)]), "day")
    stored = tables.days("f", "day", [d2])
    tables.overwrite_days("f", stored.select((F.col("v") + 10).alias("v"), F.lit("x").alias("note"), "day"), "day")
    assert rows(tables.read("f"), "v", "note", "day") == [(1, None, d1), (12, "x", d2)]


def test_directory_pages_and_lookups(spark, frame, tmp_path):
    body = ('{"Resources":[{"id":"1","active":true,"userName":"a@x","emails":[{"primary":false,"value":"n"},{"primary":true,"value":"p"}]},'
            '{"active":false,"userName":"b@x"}]}')
    users = directory.flatten_users(frame("account_id string, body string", [("acct", body), ("acct", '{"totalResults":0}')]))
    assert rows(users, "user_cd", "is_active_fl", "primary_email_lb") == [("", 0, None), ("1", 1, "p")]
    robots = directory.flatten_service_principals(frame("account_id string, body string", [("acct", '{"Resources":[{"id":"7","displayName":"r"}]}')]))
    assert rows(robots, "sp_cd", "application_cd", "is_active_fl") == [("7", "", 0)]
    (tmp_path / "apps.csv").write_text("application_cd,application_lb,domain_id,sub_domain_id\nA1,App,1,9\n")
    apps = lookups.read_lookup(spark, f"{tmp_path}/apps.csv")
    out = lookups.applications(apps, frame("domain_id string, domain_lb string", [("1", "D")]), frame("sub_domain_id string, sub_domain_lb string", []))
    assert rows(out) == [("A1", "App", "D", None)]

"""Landing folder to append-only tables, and extraction into the landing folder.

All streams are triggered runs: they take what is there and stop. Progress is in
the checkpoint, so a rerun reads only files that arrived since.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import union_type

# Landing folder of each table that is ingested, and the table it feeds.
INGESTED = {
    "system_lakeflow_jobs": "sal_lakeflow_jobs",
    "system_lakeflow_pipelines": "sal_lakeflow_pipelines",
    "system_compute_clusters": "sal_compute_clusters",
    "system_compute_warehouses": "sal_compute_warehouses",
    "system_billing_usage": "sal_billing_usage",
    "system_query_history": "sal_query_history",
    "api_users": "sal_users",
    "api_service_principals": "sal_service_principals",
    "system_billing_list_prices": "sal_billing_list_prices",
    "system_access_workspaces_latest": "sal_workspaces",
}
LOAD = "sal_load_dt"


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the source file, its modification time and the load time to a file read."""
    return df.selectExpr(
        "*",
        "_metadata.file_name as _source_file_name",
        "_metadata.file_modification_time as _source_file_dt",
        f"current_timestamp() as {LOAD}",
    )


def landed_schema(spark: SparkSession, path: str, stored: T.StructType | None = None) -> T.StructType:
    """Union of all fields seen in the landed files and those stored before.

    Fields are only ever added: a field that stops arriving stays, as NULL. Footers
    are read by a Spark job, not by the driver.
    """
    found = (
        spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path).schema
    )
    return found if stored is None else union_type(stored, found)


def ingest(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str | None = None,
) -> StreamingQuery:
    """Start one triggered stream over ``path`` and all its sub-folders."""
    if schema is None:
        schema = landed_schema(spark, path)
    source = (
        spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    )
    return (
        with_lineage(source)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_all(
    spark: SparkSession,
    landing: str,
    target_root: str,
    checkpoint_root: str,
    tables: Mapping[str, str] = INGESTED,
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, StreamingQuery]:
    """One stream per landed table; ``run_all`` waits for them."""
    return {
        table: ingest(
            spark,
            f"{landing}/{folder}",
            f"{target_root}/{table}",
            f"{checkpoint_root}/{table}",
            (schemas or {}).get(table),
        )
        for folder, table in tables.items()
    }


def run_all(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait for every stream, then raise once for all that failed. One failing table does
    not keep the others from finishing."""
    failed = {}
    for name, query in queries.items():
        try:
            query.awaitTermination()
        except Exception as error:
            failed[name] = error
    if failed:
        detail = "; ".join(f"{n}: {str(e).splitlines()[0]}" for n, e in failed.items())
        raise RuntimeError(f"{len(failed)} stream(s) failed: {detail}")


def read_appended(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Stream over an append-only table and its sub-folders. A table that is rewritten has
    no place here: read it in batch."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def extract(source: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch of an append-only source to a folder of its own, named by
    batch number: a replayed batch overwrites itself. Empty batches leave nothing.
    Spark decides the number of files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{out}/batch-{batch_id:010d}")

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def extract_snapshot(df: DataFrame, out: str, run: str) -> str | None:
    """Write a full snapshot under a name unique to the run, None when it is empty. The run
    is also a column, by which ``latest_snapshot`` picks the current one."""
    if df.isEmpty():
        return None
    path = f"{out}/{run}"
    df.withColumn("snapshot_run", F.lit(run)).write.mode("overwrite").parquet(path)
    return path

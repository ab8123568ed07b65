"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster session should carry. Adaptive execution does three jobs
# here: it merges small shuffle partitions, turns a shuffle join into a
# broadcast join once the real size of a side is known to be under the
# threshold, and splits partitions swollen by a hot join key.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call-site capture costs several round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "costloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a folder in the warehouse serves, which all executors reach as
    well: never one that a single machine holds.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    context.setCheckpointDir(shared)
    return shared


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder and read from there, for steps that read it more than once."""
    out = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(out)
    return df.sparkSession.read.parquet(out)

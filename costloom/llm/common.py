"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import ensure_checkpoint_dir

#: ASCII white space separates words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's folder, where they can reach it; a cluster without
    a shared folder gets it with ``--py-files``."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage, in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body, or a lambda in it, uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores behind it until no column has it (in any case of letters)."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name += "_"
    return name


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's plain columns: with the document id it tells apart all rows that differ."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return F.xxhash64(*(F.col(f"`{c}`") for c in plain))


def map_texts(df: DataFrame, text: str, fields: list[T.StructField], fn: Callable, drop: Iterable[str] = ()) -> DataFrame:
    """``df`` with columns that ``fn`` makes, batch by batch, from the list of texts: it returns one Arrow array a field."""
    kept = [c for c in df.columns if c not in set(drop)]
    names = kept + [f.name for f in fields]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = fn(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=names)

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), *fields]))

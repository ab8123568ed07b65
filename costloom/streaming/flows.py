"""Silver flows: append facts and fold change feeds, batch by batch.

State lives in tables, not in operator state, so a flow can stop for days and its
targets can be read in between. Each micro-batch writes a version numbered after
the batch and starts from the newest version below it; replaying a batch after a
failure therefore ends in the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc
from ..operators.keys import highest_key
from ..operators.merge import align_schemas
from ..operators.quality import expect
from ..sources.load_index import LoadIndex
from ..sources.tables import Tables, touched_days


BATCH = "batch_nb"


def _run(source: DataFrame, fold: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        source.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


Fold = Callable[[DataFrame, int], None]
Prepare = Callable[[DataFrame], DataFrame]


def feed_flow(source: DataFrame, folds: Sequence[Fold], checkpoint: str) -> StreamingQuery:
    """Fold every micro-batch of one source into several targets. The batch is read once and kept for
    all of them; as each fold may be repeated, a failure between two of them is made good by
    the replay."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for one in folds:
                one(batch, batch_id)
        finally:
            batch.unpersist()

    return _run(source, fold, checkpoint)


def append_fold(prepare: Prepare, target: str, partition_by: Sequence[str] = ()) -> Fold:
    """Append a batch under its own number; a replay writes the same folder again."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(f"{target}/{BATCH}={batch_id}")

    return fold


def index_fold(prepare: Prepare, index: LoadIndex, fact: str, folder_day: str, day: str | None = None) -> Fold:
    """Note the days of a batch in the index of loads. It stands before the fold that writes the batch, which a failure
    repeats together with it."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        index.record(fact, batch_id, prepare(batch), folder_day, day)

    return fold


def observed_fold(prepare: Prepare, rules: Mapping[str, str], report: Callable[[DataFrame, int], None], then: Callable[[Prepare], Fold]) -> Fold:
    """Count what a batch breaks of ``rules`` while another fold, made by ``then``, writes it: no pass of its own.

    ``report`` gets one row per rule once the batch is written."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        seen: list = []

        def watched(rows: DataFrame) -> DataFrame:
            rows, observation = expect(prepare(rows), rules)
            seen.append(observation)
            return rows

        then(watched)(batch, batch_id)
        counts = seen[0].get
        rows = [(rule, counts["rows"], counts[rule]) for rule in rules]
        report(batch.sparkSession.createDataFrame(rows, "rule_lb string, checked_nb bigint, failed_nb bigint"), batch_id)

    return fold


def read_appended_batches(spark, target: str, schema: T.StructType) -> DataFrame:
    """All batches that ``append_fold`` wrote, with their number; ``schema`` includes the partition columns."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(target)


def append_flow(source: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Stateless append to a Parquet folder."""
    return (
        source.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def scd1_flow(
    source: DataFrame,
    tables: Tables,
    name: str,
    keys: Sequence[str],
    seq: str,
    checkpoint: str,
    ties: Sequence[str] = (),
    id_col: str | None = None,
    seed: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Keep ``name`` at the current state of the feed. ``seed`` adds sentinel rows to a
    table that is written for the first time."""
    return _run(source, scd1_fold(_as_is, tables, name, keys, seq, ties, id_col, seed), checkpoint)


def _widened(stored: DataFrame | None, batch: DataFrame) -> DataFrame | None:
    """The stored rows with the columns and struct fields that only the batch has, as NULL."""
    if stored is None or not {f.simpleString() for f in batch.schema} - {f.simpleString() for f in stored.schema}:
        return stored
    return align_schemas(stored, batch)[0]


def _as_is(batch: DataFrame) -> DataFrame:
    return batch


def scd1_fold(
    prepare: Prepare,
    tables: Tables,
    name: str,
    keys: Sequence[str],
    seq: str,
    ties: Sequence[str] = (),
    id_col: str | None = None,
    seed: Prepare | None = None,
) -> Fold:
    """``scd1_flow`` as one of several folds of a feed."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        if (batch_id + 1) in tables.versions(name):
            return
        batch = prepare(batch)
        old = _widened(tables.read(name, before=batch_id + 1), batch)
        start = highest_key(old, id_col) if old is not None and id_col else 0
        new = cdc.scd1(old, batch, keys, seq, ties, id_col, start)
        if old is None and seed is not None:
            new = seed(new)
        tables.replace(name, new, version=batch_id + 1)

    return fold


def scd2_flow(
    source: DataFrame,
    tables: Tables,
    name: str,
    keys: Sequence[str],
    seq: str,
    checkpoint: str,
    ties: Sequence[str] = (),
) -> StreamingQuery:
    """Keep ``name`` as the version history of the feed."""
    return _run(source, scd2_fold(_as_is, tables, name, keys, seq, ties), checkpoint)


def scd2_fold(prepare: Prepare, tables: Tables, name: str, keys: Sequence[str], seq: str, ties: Sequence[str] = ()) -> Fold:
    """``scd2_flow`` as one of several folds of a feed."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        if (batch_id + 1) in tables.versions(name):
            return
        batch = prepare(batch)
        old = _widened(tables.read(name, before=batch_id + 1), batch)
        new = (
            cdc.scd2(batch, keys, seq, ties)
            if old is None
            else cdc.scd2_apply(old, batch, keys, seq, ties)
        )
        tables.replace(name, new, version=batch_id + 1)

    return fold


def scd1_by_day_flow(
    source: DataFrame,
    tables: Tables,
    name: str,
    keys: Sequence[str],
    seq: str,
    day: str,
    checkpoint: str,
    ties: Sequence[str] = (),
) -> StreamingQuery:
    """As ``scd1_flow`` for a fact that is too large to rewrite: only the days a batch
    touches are read and replaced. ``day`` must not change within a key. Folding is
    idempotent (the newest sequence wins), so a replay is harmless."""

    return feed_flow(source, [scd1_by_day_fold(_as_is, tables, name, keys, seq, day, ties)], checkpoint)


def scd1_by_day_fold(
    prepare: Prepare, tables: Tables, name: str, keys: Sequence[str], seq: str, day: str, ties: Sequence[str] = ()
) -> Fold:
    """``scd1_by_day_flow`` as one of several folds of a feed."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        batch = prepare(batch)
        days = touched_days(batch, day)
        if days:
            tables.overwrite_days(name, cdc.scd1(_widened(tables.days(name, day, days), batch), batch, keys, seq, ties), day)

    return fold

"""Change-data-capture: current state (type 1) and version history (type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .keys import fill_keys
from .latest import latest
from .compare import any_null

FROM, TO, CURRENT = "valid_from_dt", "valid_to_dt", "is_current_fl"


def scd1(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    ties: Sequence[str] = (),
    id_col: str | None = None,
    next_id: int = 0,
) -> DataFrame:
    """Fold ``changes`` into the current-state table.

    The row with the highest ``(seq, *ties)`` wins per key, wherever it comes
    from, so late changes with a lower sequence are ignored and any split of a
    feed into batches ends in the same table. Rows with a NULL key part are
    dropped (they could never be found again). With ``id_col`` the surrogate of
    an existing row survives updates and new rows are numbered from ``next_id``.
    """
    fresh = latest(changes.filter(~any_null(keys)), keys, seq, ties)
    if target is None:
        out = fresh
        if id_col:
            out = fill_keys(out.withColumn(id_col, F.lit(None).cast("bigint"))
                            .select(id_col, *fresh.columns), keys, id_col, next_id)
        return out
    columns = [c for c in target.columns if c != id_col]
    order = [seq, *[t for t in ties if t != seq]]
    old = target.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                        F.struct(*target.columns).alias("t"))
    new = fresh.select(*[F.col(k).alias(f"__n{i}") for i, k in enumerate(keys)],
                       F.struct(*columns).alias("s"))
    match = F.lit(True)
    for i in range(len(keys)):
        match = match & (F.col(f"__k{i}") == F.col(f"__n{i}"))
    newer = F.col("t").isNull() | (
        F.struct(*[F.col(f"s.{c}") for c in order]) >= F.struct(*[F.col(f"t.{c}") for c in order])
    )
    joined = old.join(new, match, "full_outer").withColumn(
        "__take", F.col("s").isNotNull() & newer
    )
    picked = [
        F.when(F.col("__take"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns
    ]
    if not id_col:
        return joined.select(*picked)
    return fill_keys(joined.select(F.col(f"t.{id_col}").alias(id_col), *picked), keys, id_col, next_id)


def scd2(
    versions: DataFrame,
    keys: Sequence[str],
    seq: str,
    ties: Sequence[str] = (),
    inclusive_end: bool = False,
    spread: str = "hour",
) -> DataFrame:
    """Attach the validity window ``[seq, next seq)`` and a current flag to each version.

    One version per key and sequence is kept. An open window has a NULL end;
    ``inclusive_end`` closes windows one microsecond before the next version.

    The next version is found in two steps so that no task has to hold the whole
    history of a busy key: inside a time slice of the key (``spread``), and, for
    the last version of a slice, from the first version of the next slice that
    has one. The slice table has one row per key and non-empty slice.
    """
    sliced = (
        versions.filter(~any_null(keys))
        .withColumn("__slice", F.date_trunc(spread, F.col(seq)))
        # One shuffle serves the de-duplication, the lead and the join below.
        .repartition(*keys, "__slice")
    )
    single = latest(sliced, [*keys, "__slice", seq], ties)
    firsts = (
        sliced.groupBy(*keys, "__slice").agg(F.min(seq).alias("__first"))
        .withColumn("__follow", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__slice")))
        .drop("__first")
    )
    inside = F.lead(seq).over(Window.partitionBy(*keys, "__slice").orderBy(seq))
    following = (
        single.withColumn("__next", inside)
        .join(firsts, [*keys, "__slice"])
        .withColumn("__next", F.coalesce("__next", "__follow"))
    )
    end = F.col("__next")
    if inclusive_end:
        end = end - F.expr("interval 1 microsecond")
    names = [c for c in versions.columns if c not in (FROM, TO, CURRENT)]
    return following.select(
        *names,
        F.col(seq).alias(FROM),
        end.alias(TO),
        F.when(F.col("__next").isNull(), 1).otherwise(0).alias(CURRENT),
    )


def affected_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return changes.select(*keys).distinct()


def scd2_apply(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    ties: Sequence[str] = (),
    all_versions: DataFrame | None = None,
    inclusive_end: bool = False,
    spread: str = "hour",
) -> DataFrame:
    """History after ``changes``: windows are derived again for touched keys only.

    Versions of touched keys come from the history itself, or from
    ``all_versions`` when the caller keeps the full feed.
    """
    touched = affected_keys(changes, keys)
    plain = [c for c in history.columns if c not in (FROM, TO, CURRENT)]
    if all_versions is None:
        known = history.join(touched, list(keys), "left_semi").select(*plain)
        versions = known.unionByName(changes.select(*plain))
    else:
        versions = all_versions.join(touched, list(keys), "left_semi").select(*plain)
    renewed = scd2(versions, keys, seq, ties, inclusive_end, spread)
    untouched = history.join(touched, list(keys), "left_anti")
    return untouched.unionByName(renewed.select(*history.columns))


def current_of(history: DataFrame) -> DataFrame:
    """Open versions of an SCD2 table: the SCD1 view of it."""
    return history.filter(F.col(CURRENT) == 1)

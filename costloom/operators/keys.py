"""Surrogate keys, sentinel rows and foreign-key resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .latest import latest
from .spread import SPREAD, grouped_for_join, with_spread


def assign_keys(
    new_rows: DataFrame,
    natural_key: Sequence[str],
    id_col: str,
    start: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Number rows ``start+1 .. start+n`` without a gap and without one big sort.

    Rows are hashed on the natural key into buckets, as many as the session's shuffle
    partitions unless told, and numbered inside each bucket; a table of at most ``buckets``
    counts gives every bucket its offset. The same input and buckets always give the same
    numbers. The natural key must be unique.
    """
    buckets = buckets or int(new_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = new_rows.drop(id_col).withColumn(
        "__bucket", F.pmod(F.xxhash64(*natural_key), F.lit(buckets)).cast("int")
    )
    counts = spread.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    # At most `buckets` rows, so one task and a broadcast are bounded by that constant.
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy("__bucket").orderBy(*natural_key)
    return (
        spread.withColumn("__rn", F.row_number().over(inside))
        .join(F.broadcast(offsets), "__bucket")
        .withColumn(id_col, (F.lit(start) + F.col("__offset") + F.col("__rn")).cast("bigint"))
        .select(id_col, *[c for c in new_rows.columns if c != id_col])
    )


def highest_key(dim: DataFrame, id_col: str) -> int:
    """Largest positive key in use, 0 when there is none. Runs one aggregate."""
    top = dim.filter(F.col(id_col) > 0).agg(F.max(id_col)).first()[0]
    return int(top or 0)


def fill_keys(dim: DataFrame, natural_key: Sequence[str], id_col: str, start: int) -> DataFrame:
    """Give rows whose ``id_col`` is NULL fresh keys above ``start``; keep the others."""
    kept = dim.filter(F.col(id_col).isNotNull())
    fresh = assign_keys(dim.filter(F.col(id_col).isNull()), natural_key, id_col, start)
    return kept.unionByName(fresh)


def with_new_keys(source: DataFrame, dim: DataFrame, natural_key: Sequence[str], id_col: str) -> DataFrame:
    """``source`` with a fresh ``id_col`` on rows that ``dim`` lacks, NULL on the others, ready to
    be merged into ``dim``.

    Only the dimension's keys are read for this, so the merge that follows is the only pass
    over whole rows. As in the merge, a NULL key part matches nothing.
    """
    keys = dim.select(*natural_key)
    known = source.join(keys, list(natural_key), "left_semi").withColumn(id_col, F.lit(None).cast("bigint"))
    new = source.join(keys, list(natural_key), "left_anti")
    numbered = assign_keys(new.withColumn(id_col, F.lit(None)), natural_key, id_col, highest_key(dim, id_col))
    return known.unionByName(numbered)


STAMPS = ("create_dt", "change_time", "sys_create_dt", "sys_update_dt", "sys_load_dt")


def with_sentinels(
    dim: DataFrame,
    rows: Sequence[Mapping[str, object]],
    id_col: str,
    stamps: Sequence[str] = STAMPS,
) -> DataFrame:
    """Add the fixed placeholder rows a dimension lacks. Running it twice adds nothing.

    ``rows`` is a short literal list; columns it does not name become NULL, except
    the ``stamps``, which get the current time.
    """
    spark = dim.sparkSession
    fields = {f.name: f.dataType for f in dim.schema.fields}
    literal = spark.createDataFrame(
        [tuple(r.get(c) for c in dim.columns) for r in rows],
        schema=_nullable(dim),
    ).select(*[
        F.coalesce(F.col(c), F.current_timestamp().cast(fields[c])).alias(c) if c in stamps
        else F.col(c)
        for c in dim.columns
    ])
    present = dim.filter(F.col(id_col).isin([r[id_col] for r in rows])).select(id_col)
    return dim.unionByName(literal.join(present, id_col, "left_anti").select(*dim.columns))


def _nullable(df: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


def real_rows(dim: DataFrame, id_col: str) -> DataFrame:
    """Drop sentinel rows (surrogate key at or below zero)."""
    return dim.filter(F.col(id_col) > 0)


def resolve_fk(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str | Column] | Sequence[str],
    key: str,
    fallback: Column | int,
    prefer: Sequence[str] = (),
    alias: str | None = None,
    carry: Sequence[str] = (),
    sentinels: Sequence[int] = (),
) -> DataFrame:
    """Add the surrogate ``key`` of ``dim`` to ``fact``; misses get ``fallback``.

    ``on`` maps a dimension column to the fact column (or expression) it must
    equal. The fact never changes its row count: a dimension key that is not
    unique is first reduced to one row, highest ``prefer`` columns first and then
    the smallest surrogate. Only the columns needed for this are read. No
    broadcast hint is given: dimensions can reach millions of rows, so the size
    measured at run time decides between a broadcast and a shuffle join, and
    adaptive execution splits a shuffle partition swollen by a hot key.

    Several keys of text meet as one hash, so the fact is shuffled and sorted by a single number and carries no
    second copy of its keys; the keys themselves are compared where hashes are equal.

    ``carry`` columns of the dimension come along, where its surrogates are unique; a miss has those of the
    dimension's row for its fallback, if there is one among the ``sentinels``.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    out, carry = alias or key, list(carry)
    usable = dim.filter(F.col(key).isNotNull())
    if prefer:
        narrow = usable.select(*dict.fromkeys([*pairs, key, *prefer, *carry]))
        order = [*[F.col(c).desc_nulls_last() for c in prefer], F.col(key).asc()]
        one = latest(with_spread(narrow, list(pairs)), [*pairs, SPREAD], order)
    elif carry:
        first = F.min(F.struct(key, *carry)).alias("__first")
        one = grouped_for_join(usable, list(pairs), first).select(*pairs, "__first.*")
    else:
        one = grouped_for_join(usable, list(pairs), F.min(key).alias(key))
    side = one.select(
        F.col(key).alias("__fk"), *[F.col(c).alias(f"__on_{i}") for i, c in enumerate(pairs)],
        *[F.col(c).alias(f"__carry_{c}") for c in carry],
    )
    sources = [F.col(s) if isinstance(s, str) else s for s in pairs.values()]
    texts = [f.dataType for f in [*fact.select(*sources).schema, *usable.select(*pairs).schema]]
    same = [s == F.col(f"__on_{i}") for i, s in enumerate(sources)]
    work = fact
    if len(pairs) > 1 and all(t == T.StringType() for t in texts):
        work = fact.withColumn("__hash", F.xxhash64(*sources))
        side = side.withColumn("__side_hash", F.xxhash64(*[f"__on_{i}" for i in range(len(pairs))]))
        same.append(F.col("__hash") == F.col("__side_hash"))
        # Only the hash is a join key; a key wrapped in one struct would be shuffled and sorted like the texts.
        condition = reduce(lambda a, c: a & c, [same[-1], *[F.coalesce(c, F.lit(False)) for c in same[:-1]]])
    else:
        condition = reduce(lambda a, c: a & c, same)
    miss = (F.lit(fallback) if not isinstance(fallback, Column) else fallback).cast("bigint")
    joined = work.join(side, condition, "left")
    names = [F.col(f"`{c}`") for c in fact.columns if c != out and c not in carry]
    found = joined.select(*names, F.coalesce(F.col("__fk"), miss).alias(out), *[F.col(f"__carry_{c}").alias(c) for c in carry],
                          *([F.col("__fk").isNull().alias("__missed")] if carry else []))
    if not carry:
        return found
    # One row per fallback: bounded by their number.
    rows = usable.filter(F.col(key).isin(list(sentinels))).select(F.col(key).alias("__key"), *[F.col(c).alias(f"__own_{c}") for c in carry])
    with_own = found.join(F.broadcast(rows), F.col("__missed") & (F.col(out) == F.col("__key")), "left")
    return with_own.select(*names, out, *[F.when(F.col("__missed"), F.col(f"__own_{c}")).otherwise(F.col(c)).alias(c) for c in carry])


def repeated_keys(dim: DataFrame, key: str) -> bool:
    """Whether a surrogate of ``dim`` stands in more than one row. Runs one aggregate."""
    many = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return not many.isEmpty()

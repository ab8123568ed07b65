"""Keyed merge of a source into a target as one full outer join.

Plain Parquet tables have no ``MERGE``; this operator computes the table a
guarded merge would leave behind. Writing it is the caller's business
(`sources.tables`), so the same code serves batch jobs and ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .compare import _has_map, any_null, differs

ACTION = "__action"


def _nullsafe_lane(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for rows with a full key; a content hash where a key part is NULL.

    Such rows never match anything, but a plain join would send all of them to
    the one partition NULL hashes to.
    """
    hashable = [f"`{f.name}`" for f in df.schema.fields if not _has_map(f.dataType)]
    return F.when(any_null(keys), F.xxhash64(*hashable)).otherwise(F.lit(0).cast("bigint"))


#: Key types of which equal values always hash alike.
_PLAIN = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.DecimalType)


def _hash_alike(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> bool:
    kinds = [{f.name: f.dataType for f in df.schema.fields} for df in (target, source)]
    return all(kinds[0][k] == kinds[1][k] and (kinds[0][k] == T.StringType() or isinstance(kinds[0][k], _PLAIN)) for k in keys)


def _as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    guard: Sequence[str] = (),
    update: Mapping[str, Column | object] | Sequence[str] | None = None,
    insert: Mapping[str, Column | object] | None = None,
    also_when: Column | None = None,
    by_source: str | Mapping[str, Column | object] | None = None,
    by_source_when: Column | None = None,
    evolve: bool = False,
    actions: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Return ``target`` after merging ``source`` on ``keys``.

    In every expression ``t.x`` is the target column and ``s.x`` the source one.

    * matched and any ``guard`` column distinct (or ``also_when`` true): ``update``
      is applied. ``update`` names source columns, or maps target columns to
      expressions; default is the guard columns.
    * not matched: a row of same-named source columns plus ``insert`` overrides.
    * only in target: ``by_source='delete'`` removes the row, a mapping rewrites
      columns; ``by_source_when`` restricts both.

    Keys compare with ``=``, so rows with a NULL key part never match. Two source
    rows for one target row raise an error when there is an update branch.
    ``evolve`` adds columns only the source has and widens nested structs.
    ``actions`` keeps the ``__action`` column: insert, update, keep, close.
    ``null_safe`` lets NULL key parts match each other; the keys must then tell rows apart all
    the same, so that no partition collects what is NULL.

    Rows meet by one hash of their keys, so they are shuffled and sorted by a number and carry no second copy of the keys; the
    keys themselves are compared where hashes are equal. Keys of other types, or of two types, are joined as they are.
    """
    if evolve:
        target, source = align_schemas(target, source)
    if update is None:
        update = list(guard)
    assignments = (
        {c: _as_column(v) for c, v in update.items()}
        if isinstance(update, Mapping)
        else {c: F.col(f"s.`{c}`") for c in update}
    )
    has_update = bool(assignments)

    # Plain columns rather than structs: those that no later step reads are not shuffled.
    hashed = _hash_alike(target, source, keys)
    sides = []
    for df, side in ((target, "t"), (source, "s")):
        lane = (F.lit(0) if null_safe else _nullsafe_lane(df, keys)).cast("bigint")
        if hashed:
            lane = F.xxhash64(*keys) if null_safe else F.when(any_null(keys), lane).otherwise(F.xxhash64(*keys))
        copies = [] if hashed else [F.col(k).alias(f"__{side}_{i}") for i, k in enumerate(keys)]
        sides.append(df.select(*[F.col(f"`{c}`").alias(c) for c in df.columns], F.lit(True).alias(f"__in_{side}"), *copies,
                               lane.alias(f"__{side}_lane")))
    left, right = sides
    if has_update:
        # Same clustering as the join below, so looking for duplicates costs no extra shuffle.
        if hashed:
            along = Window.partitionBy("__s_lane").orderBy(*keys)
            again = F.lag(F.lit(True)).over(along).isNotNull()
            for k in keys:
                again = again & F.lag(k).over(along).eqNullSafe(F.col(k))
        else:
            source_keys = [f"__s_{i}" for i in range(len(keys))] + ["__s_lane"]
            again = F.row_number().over(Window.partitionBy(*source_keys).orderBy(*source_keys)) > 1
        right = right.withColumn("__dup", again)
    condition = F.lit(True)
    for i, k in enumerate(keys):
        t, s = (F.col(f"t.`{k}`"), F.col(f"s.`{k}`")) if hashed else (F.col(f"__t_{i}"), F.col(f"__s_{i}"))
        condition = condition & (t.eqNullSafe(s) if null_safe else t == s)
    lanes = F.col("__t_lane") == F.col("__s_lane")
    # Only the hash is a join key: what stands under a condition on both sides is not taken for one.
    condition = lanes & (F.coalesce(F.when(lanes, condition), F.lit(False)) if hashed else condition)
    joined = left.alias("t").join(right.alias("s"), condition, "full_outer")

    in_target, in_source = F.col("__in_t").isNotNull(), F.col("__in_s").isNotNull()
    kinds = {f.name: f.dataType for f in target.schema.fields}
    changed = F.lit(False) if also_when is None else F.coalesce(also_when, F.lit(False))
    for c in guard:
        changed = changed | differs(F.col(f"t.`{c}`"), F.col(f"s.`{c}`"), kinds[c])
    if not guard and also_when is None:
        changed = F.lit(has_update)
    gone = in_target & ~in_source
    if by_source_when is not None:
        gone = gone & F.coalesce(by_source_when, F.lit(False))
    action = (
        F.when(~in_target, "insert")
        .when(in_source & changed & F.lit(has_update), "update")
        .when(gone & F.lit(by_source is not None), "close")
        .otherwise("keep")
    )
    joined = joined.withColumn(ACTION, action)
    if has_update:
        clash = F.raise_error(F.lit("merge: several source rows match one target row"))
        joined = joined.filter(
            F.when(in_target & in_source & F.col("__dup"), clash.cast("boolean")).otherwise(True)
        )
    if by_source == "delete":
        joined = joined.filter(F.col(ACTION) != "close")
    closing = by_source if isinstance(by_source, Mapping) else {}

    inserts = {c: _as_column(v) for c, v in (insert or {}).items()}
    source_cols = set(source.columns)
    out = []
    for c in target.columns:
        kind = kinds[c]
        fresh = inserts.get(c, F.col(f"s.`{c}`") if c in source_cols else F.lit(None))
        value = F.when(F.col(ACTION) == "insert", fresh.cast(kind))
        if c in assignments:
            value = value.when(F.col(ACTION) == "update", assignments[c].cast(kind))
        if c in closing:
            value = value.when(F.col(ACTION) == "close", _as_column(closing[c]).cast(kind))
        out.append(value.otherwise(F.col(f"t.`{c}`")).alias(c))
    if actions:
        out.append(F.col(ACTION))
    return joined.select(*out)


def align_schemas(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give both frames the union of their columns and nested struct fields."""
    wide = union_type(left.schema, right.schema)

    def cast(df: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in df.schema.fields}
        cols = []
        for field in wide.fields:
            if field.name not in have:
                cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            else:
                cols.append(
                    _widen(F.col(f"`{field.name}`"), have[field.name], field.dataType).alias(field.name)
                )
        return df.select(*cols)

    return cast(left), cast(right)


def union_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Fields of ``a`` followed by those only ``b`` has, recursively."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f for f in b.fields}
        fields = [
            T.StructField(f.name, union_type(f.dataType, other[f.name].dataType), True)
            if f.name in other
            else f
            for f in a.fields
        ]
        known = {f.name for f in a.fields}
        return T.StructType(fields + [f for f in b.fields if f.name not in known])
    if isinstance(a, T.NullType):
        return b
    return a


def _widen(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want or not isinstance(want, T.StructType) or not isinstance(have, T.StructType):
        return column.cast(want)
    known = {f.name: f.dataType for f in have.fields}
    fields = [
        _widen(column.getField(f.name), known[f.name], f.dataType).alias(f.name)
        if f.name in known
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in want.fields
    ]
    return F.when(column.isNotNull(), F.struct(*fields))

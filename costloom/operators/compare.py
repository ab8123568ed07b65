"""Null-safe comparison and hashing over any column type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return False


def comparable(column: Column, dtype: T.DataType) -> Column:
    """A form of ``column`` that ``<=>`` and hash functions accept.

    Maps become their entries in sorted key order, so two maps that hold the
    same pairs in another order count as equal.
    """
    if not _has_map(dtype):
        return column
    if isinstance(dtype, T.MapType) and not _has_map(dtype.valueType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(column)


def differs(left: Column, right: Column, dtype: T.DataType) -> Column:
    """``left IS DISTINCT FROM right``."""
    return ~comparable(left, dtype).eqNullSafe(comparable(right, dtype))


def row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """Deterministic 64-bit hash over the given (default: all) columns."""
    names = list(columns) if columns is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.xxhash64(*[comparable(F.col(f"`{n}`"), kinds[n]) for n in names])


def any_null(columns: Iterable[str], prefix: str = "") -> Column:
    test = F.lit(False)
    for name in columns:
        test = test | F.col(f"{prefix}`{name}`").isNull()
    return test

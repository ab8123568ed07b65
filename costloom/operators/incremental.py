"""Arrival-time increments and high-water marks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

EPOCH = dt.datetime(1970, 1, 1)


def high_water_mark(table: DataFrame | None, load_col: str) -> dt.datetime:
    """Newest ``load_col`` in ``table``, the epoch when there is none. One aggregate."""
    if table is None:
        return EPOCH
    return table.agg(F.max(load_col)).first()[0] or EPOCH


def incremental(df: DataFrame, load_col: str, mark: dt.datetime) -> DataFrame:
    """Rows that arrived after ``mark``, whatever their event date.

    ``mark`` is a literal, so the comparison is pushed into the Parquet scan and
    row groups without newer rows are skipped.
    """
    return df.filter(F.col(load_col) > F.lit(mark))


def next_mark(batch: DataFrame, load_col: str, mark: dt.datetime) -> DataFrame:
    """One row: the mark to store after ``batch``; an empty batch keeps the old one."""
    return batch.agg(F.coalesce(F.max(load_col), F.lit(mark)).alias("last_processed_dt"))


def next_mark_of(left: DataFrame, right: DataFrame, load_col: str, mark: dt.datetime) -> DataFrame:
    """The later of two sources' marks, for a table fed by both."""
    both = left.select(load_col).unionByName(right.select(load_col))
    return next_mark(both, load_col, mark)


def upsert_mark(marks: DataFrame, table_name: str, value: DataFrame, account_id: str = "*") -> DataFrame:
    """Control table with the row of ``table_name`` set to the one-row ``value``."""
    row = value.select(
        F.lit(table_name).alias("table_name"),
        F.lit(account_id).alias("account_id"),
        F.col("last_processed_dt"),
        F.current_timestamp().alias("sys_update_dt"),
    )
    rest = marks.filter(~((F.col("table_name") == table_name) & (F.col("account_id") == account_id)))
    return rest.unionByName(row)


def stored_mark(marks: DataFrame | None, table_name: str, account_id: str = "*") -> dt.datetime:
    if marks is None:
        return EPOCH
    row = (
        marks.filter((F.col("table_name") == table_name) & (F.col("account_id") == account_id))
        .agg(F.max("last_processed_dt"))
        .first()
    )
    return row[0] or EPOCH

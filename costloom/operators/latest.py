"""One row per key, chosen by sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .compare import row_hash


def _directed(column: str | Column, newest: bool) -> Column:
    """A name follows ``keep``; a Column that already carries a direction is left alone."""
    if not isinstance(column, str):
        return column
    return F.col(column).desc_nulls_last() if newest else F.col(column).asc_nulls_last()


def latest(
    df: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str | Column],
    ties: Sequence[str | Column] = (),
    keep: str = "last",
) -> DataFrame:
    """Keep the row with the highest (``keep='first'``: lowest) sequence per key.

    ``ties`` order rows of equal sequence the same way as ``seq`` (pass a sorted
    Column to fix a direction); a content hash settles what is left, so reruns and other file layouts pick the same
    row. Spark plans the ``row_number = 1`` filter as a group limit below the
    shuffle: each map task forwards one row per key, so a hot key never reaches
    a single task whole.
    """
    newest = keep == "last"
    seqs = [seq] if isinstance(seq, (str, Column)) else list(seq)
    order = [_directed(c, newest) for c in [*seqs, *ties]] + [row_hash(df)]
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def latest_snapshot(df: DataFrame, run_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest full snapshot only (optionally the newest per ``by``)."""
    newest = df.groupBy(*by).agg(F.max(run_col).alias(run_col))
    return df.join(newest, [*by, run_col], "left_semi")

"""Keeping many-to-one joins splittable.

Adaptive execution can broadcast a measured-small side, or split a partition
swollen by a hot key, only when each side of the join arrives through a shuffle
of its own. A side that was just grouped on the join keys is already partitioned
that way, so Spark would reuse that layout and lose both options. Grouping on
the keys plus a value computed from them yields the same groups in a layout the
join cannot reuse; the extra shuffle moves only the small, reduced side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SPREAD = "__spread"


def with_spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(SPREAD, F.xxhash64(*keys))


def grouped_for_join(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``groupBy(keys).agg(...)`` whose result joins on ``keys`` through a fresh shuffle."""
    return with_spread(df, keys).groupBy(*keys, SPREAD).agg(*aggregates).drop(SPREAD)

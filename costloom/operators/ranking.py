"""Ranks, top-n and exact percentiles without putting all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

CUTS = 200


def top_n(df: DataFrame, value: str, n: int, dense: bool = True, rank_as: str = "rank_nb") -> DataFrame:
    """Rows ranked ``<= n`` by descending ``value``, ties kept.

    Dense rank: rows holding one of the ``n`` highest distinct values. Skip rank:
    rank is one plus the number of rows above. Either way a distributed top-k
    yields at most ``n`` values first; joining them back (at most ``n`` rows, so the
    broadcast is bounded by the argument) finds the tied rows.
    """
    filled = df.filter(F.col(value).isNotNull())
    if dense:
        best = filled.select(value).distinct().orderBy(F.col(value).desc()).limit(n)
        ranked = best.withColumn(rank_as, F.row_number().over(Window.orderBy(F.col(value).desc())))
    else:
        best = filled.select(value).orderBy(F.col(value).desc()).limit(n)
        ranked = best.withColumn(rank_as, F.rank().over(Window.orderBy(F.col(value).desc()))).distinct()
    return filled.join(F.broadcast(ranked), value).select(*df.columns, rank_as)


def global_rank(
    df: DataFrame, value: str, dense: bool = True, rank_as: str = "rank_nb", cuts: int = CUTS
) -> DataFrame:
    """Rank every row by descending ``value`` over the whole table; NULL ranks last.

    Distinct values are ranked, rows only look their rank up, so a value that most
    rows share costs one row. Approximate percentiles of the distinct values (one
    aggregate, ``cuts`` numbers) slice the value range; a running count inside a slice
    plus the counts of the slices above is exact whatever the cut points are.
    """
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    points = counted.agg(
        F.percentile_approx(F.col(value).cast("double"), [i / cuts for i in range(1, cuts)])
    ).first()[0] or []
    edges = F.array(*[F.lit(float(p)) for p in sorted(set(points))]).cast("array<double>")
    slice_no = F.when(F.col(value).isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(edges, lambda e: e < F.col(value).cast("double")))
    )
    step = F.lit(1) if dense else F.col("__n")
    sliced = counted.withColumn("__slice", slice_no).withColumn("__step", step)
    inside = (
        Window.partitionBy("__slice").orderBy(F.col(value).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per slice (at most `cuts` + 1): a bounded window and broadcast.
    above = Window.orderBy(F.col("__slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("__slice").agg(F.sum("__step").alias("__size")).select(
        "__slice", F.coalesce(F.sum("__size").over(above), F.lit(0)).alias("__above")
    )
    ranks = (
        sliced.withColumn("__before", F.coalesce(F.sum("__step").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "__slice")
        .select(F.col(value).alias("__value"),
                (F.col("__before") + F.col("__above") + 1).cast("int").alias(rank_as))
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__value"))).select(*df.columns, rank_as)


def percentile_inc(
    df: DataFrame, value: str, p: float, by: Sequence[str] = (), out: str = "percentile_nb"
) -> DataFrame:
    """Exact inclusive percentile (linear interpolation) of a number per group, in its own type.

    Spark's own exact percentile keeps all distinct values of a group in one
    aggregation buffer. Here values are counted first, then grouped into
    magnitude bins; the cumulative bin sizes tell which bin holds the wanted ranks
    and only the counts of those bins are put in order.
    """
    return percentile_of_counts(df.withColumn("__one", F.lit(1)), value, "__one", p, by, out)


def percentile_of_counts(
    df: DataFrame, value: str, count: str, p: float, by: Sequence[str] = (), out: str = "percentile_nb"
) -> DataFrame:
    """``percentile_inc`` where each row stands for ``count`` equal values, as kept in a table of counts."""
    by = list(by)
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("bigint" if whole else "double").alias("__v"))
        .agg(F.sum(count).alias("__c"))
        .withColumn("__bin", _bin(F.col("__v") if whole else _floor(F.col("__v"))))
    )
    # A few thousand bins at most per group, whatever the number of rows.
    order = Window.partitionBy(*by).orderBy("__bin")
    bins = (
        counted.groupBy(*by, "__bin").agg(F.sum("__c").alias("__n"))
        .withColumn("__upto", F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__all", F.sum("__n").over(Window.partitionBy(*by)))
        .withColumn("__pos", F.lit(p) * (F.col("__all") - 1))
        .withColumn("__lo", F.floor("__pos"))
        .withColumn("__hi", F.ceil("__pos"))
        .withColumn("__base", F.col("__upto") - F.col("__n"))
        .filter((F.col("__base") <= F.col("__hi")) & (F.col("__upto") > F.col("__lo")))
        .select(*by, "__bin", "__base", "__pos", "__lo", "__hi")
    )
    on = [*by, "__bin"]
    within = Window.partitionBy(*on).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.join(bins, on).withColumn("__end", F.col("__base") + F.sum("__c").over(within))
    start = F.col("__end") - F.col("__c")

    def at(rank: str):
        return F.max(F.when((start <= F.col(rank)) & (F.col("__end") > F.col(rank)), F.col("__v")))

    found = placed.groupBy(*by).agg(
        at("__lo").alias("__vlo"), at("__hi").alias("__vhi"),
        F.max(F.col("__pos") - F.col("__lo")).alias("__part"),
    )
    return found.select(
        *by, (F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__part")).alias(out)
    )


def _floor(v):
    """The integer below, within the range of a long: order is kept, which is all a bin needs."""
    return F.floor(F.greatest(F.least(v, F.lit(9e18)), F.lit(-9e18))).cast("bigint")


def _bin(v):
    """Order-preserving magnitude bin of an integer: its sign, binary digit count and
    leading eight bits. Values of a bin differ by less than one percent."""
    size = F.abs(v)
    digits = F.length(F.bin(size))
    tail = F.greatest(digits - 8, F.lit(0))
    head = F.call_function("shiftright", size, tail)
    return F.when(v < 0, -(tail * 256 + head)).otherwise(tail * 256 + head)


def share(df: DataFrame, value: str, within: Sequence[str] = (), out: str = "share_nb") -> DataFrame:
    """``value`` over its total per ``within``; NULL when the total is 0.

    The total is aggregated and joined back, so neither one task nor one group has
    to hold all rows; the unfiltered total is a single row.
    """
    total = df.groupBy(*within).agg(F.sum(value).alias("__total"))
    if within:
        same = F.lit(True)
        side = total.select("__total", *[F.col(c).alias(f"__w_{c}") for c in within])
        for c in within:
            same = same & F.col(c).eqNullSafe(F.col(f"__w_{c}"))
        joined = df.join(side, same)
    else:
        joined = df.withColumn("__total", total.scalar())
    ratio = F.try_divide(F.col(value).cast("double"), F.col("__total").cast("double"))
    return joined.select(*df.columns, ratio.alias(out))

"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only.

Every source has a total (its target, in words) and a weight schedule over training time from 0 to 1. The
schedule's integral, scaled to the target, is the source's cumulative demand D(t). A document that covers the
words from a to b of its source's stream is trained on at D^-1 of its middle. Documents are sorted by that position.

The stream of a source is its documents in the order of a hash of their id, passed through as often as the
target asks for; the last document of the last pass gives only the words still wanted. Prefix sums run over slices
of about ``SLICE`` documents and then over the slices, so a source with a third of all rows is many tasks' work.

Null texts have size 0, null sources are one source and sort last, null ids hash as the empty text. Repeated rows
take their places one behind the other. Documents of size 0 are never taken. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, checkpointed, fresh, let, row_hash

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Schedules by weight: values at equally spaced times from 0 to 1, with straight lines between them.
SCHEDULES: Mapping[int, Sequence[float]] = {5: (1.5, 0.5), 2: (1.0, 1.0), 1: (0.5, 1.5)}
SLICE = 1000
MAX_PASSES = 2


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def position(share: Column, knots: Column) -> Column:
    """The time by which ``share`` of a schedule's integral is reached.

    ``knots``: weights at equally spaced times. Within a stretch from weight a to b the integral is quadratic.
    """
    stretches = F.size(knots) - 1
    width = F.lit(1.0) / stretches
    area = lambda i: (F.get(knots, i) + F.get(knots, i + 1)) / 2 * width
    total = F.aggregate(F.sequence(F.lit(0), stretches - 1), F.lit(0.0), lambda s, i: s + area(i))

    def walk(state: Column, i: Column) -> Column:
        a, b, rest = F.get(knots, i), F.get(knots, i + 1), state["rest"]
        root = a + F.sqrt(F.greatest(a * a + 2 * (b - a) * rest / width, F.lit(0.0)))
        inside = F.coalesce(F.try_divide(2 * rest, root), F.lit(0.0))
        ends = ~state["done"] & ((rest <= area(i)) | (i == stretches - 1))
        return F.struct(
            F.when(state["done"], rest).otherwise(rest - area(i)).alias("rest"),
            F.when(state["done"], state["at"]).when(ends, state["at"] + inside).otherwise(state["at"] + width).alias("at"),
            (state["done"] | ends).alias("done"))

    start = F.struct((share * total).alias("rest"), F.lit(0.0).alias("at"), F.lit(False).alias("done"))
    return F.least(F.aggregate(F.sequence(F.lit(0), stretches - 1), start, walk, lambda s: s["at"]), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """``(source, size)`` to one row per source: source_size, documents, weight, target.

    The targets share one and a half times all sizes by weight, none above ``passes`` times its source's size.
    With the sources in the order of size to weight, the common level per unit of weight rises as sources
    reach their limit and falls afterwards: its largest value is the level at which all is dealt out.
    The windows see one row per source, after the sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.get(F.array(*map(F.lit, weights)), number % len(weights)).cast("long"))
    by = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    before = F.coalesce(F.sum(passes * F.col("source_size")).over(by), F.lit(0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by), F.lit(0))
    level = (3 * F.sum("source_size").over(every) - 2 * before).cast("double") / (2 * rest).cast("double")
    return per.withColumn("level", level).select(
        "source", "source_size", "documents", "weight",
        F.least((passes * F.col("source_size")).cast("double"), F.max("level").over(every) * F.col("weight")).alias("target"))


def mix(rows: DataFrame, weights: Sequence[int] = WEIGHTS, schedules: Mapping[int, Sequence[float]] = SCHEDULES,
        slice_rows: int = SLICE, passes: int = MAX_PASSES) -> DataFrame:
    """``(id, row, source, size)`` to the same rows with source_size, target, taken and ``takes``, an array of
    (pass, words, position)."""
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = checkpointed(rows.select("id", "row", "source", "size", digest.alias("digest")))
    targets = checkpointed(source_targets(rows, weights, passes))
    knots = F.create_map(*(x for k, v in schedules.items() for x in (F.lit(k).cast("long"), F.array(*map(F.lit, map(float, v))))))
    part = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    number = F.floor(part * F.ceil(F.col("documents") / slice_rows) / F.lit(2**32)).cast("long")
    dealt = rows.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.*", "t.source_size", "t.weight", "t.target", number.alias("slice"))
    along = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = dealt.groupBy("source", "slice").agg(F.sum("size").alias("__sum")).select(
        F.col("source").alias("__source"), F.col("slice").alias("__slice"),
        F.coalesce(F.sum("__sum").over(along), F.lit(0)).alias("__base"))
    within = W.partitionBy("source", "slice").orderBy("digest", "id", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = dealt.withColumn("__at", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        slices, F.col("source").eqNullSafe(F.col("__source")) & (F.col("slice") == F.col("__slice")))
    wanted = F.floor(F.col("target") + 0.5)

    def one(p: Column) -> Column:
        begin = p * F.col("source_size") + F.col("__base") + F.col("__at")
        got = F.greatest(F.least(wanted - begin, F.col("size")), F.lit(0))
        middle = F.try_divide(begin + got / 2, wanted.cast("double"))
        return F.struct(p.cast("int").alias("pass"), got.cast("long").alias("words"), middle.alias("share"))

    takes = F.filter(F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), one), lambda t: t["words"] > 0)
    with_place = let(F.element_at(knots, F.col("weight")), lambda k: F.transform(F.col("__takes"), lambda t: F.struct(
        t["pass"].alias("pass"), t["words"].alias("words"), F.round(position(t["share"], k), 9).alias("position"))))
    return placed.withColumn("__takes", takes).select(
        "id", "row", "source", "size", "source_size", "target",
        F.aggregate("__takes", F.lit(0).cast("long"), lambda a, t: a + t["words"]).alias("taken"), with_place.alias("takes"))


def _rows(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), row_hash(docs).alias("row"), F.col(source).alias("source"), words(F.col(text)).alias("size"))


def targets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document with what the mix takes of it, sorted by the position of its first pass."""
    return mix(_rows(docs, text, doc_id, source)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
        F.get(F.col("takes")["position"], F.lit(0)).alias("first_position")).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


def curriculum(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: one row of ``docs`` per copy that is taken, with mix_pass, mix_words and mix_position, sorted by position."""
    key = ["__id", "__row"]
    nth = F.row_number().over(W.partitionBy(*key).orderBy(F.lit(0)))
    taken = mix(_rows(docs, text, doc_id, source)).select(
        F.col("id").alias("__id"), F.col("row").alias("__row"), "takes", F.row_number().over(W.partitionBy("id", "row").orderBy(
            F.get(F.col("takes")["position"], F.lit(0)))).alias("__nth")).filter(F.size("takes") > 0)
    whole = docs.select(F.col(doc_id).alias("__id"), row_hash(docs).alias("__row"), F.struct("*").alias("__doc")).withColumn("__nth", nth)
    same = F.col("d.__id").eqNullSafe(F.col("t.__id")) & (F.col("d.__row") == F.col("t.__row")) & (F.col("d.__nth") == F.col("t.__nth"))
    copies = whole.alias("d").join(taken.alias("t"), same).select("d.__doc", F.explode("t.takes").alias("__take"))
    names = {c: fresh(f"mix_{c}", docs.columns) for c in ("pass", "words", "position")}
    return copies.select("__doc.*", *(F.col(f"__take.{c}").alias(n) for c, n in names.items())).orderBy(
        names["position"], doc_id)

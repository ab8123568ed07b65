"""Tag keys and the resource x tag bridge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .compare import any_null

# Raw tag key (upper case) and the label it is reported under.
TAG_LABELS = {
    "APP_ID": "AppId",
    "DATA_PRODUCT": "Data Product",
    "DATAPRODUCT": "Data Product",
    "DATAPRODUCT_TYPE": "Data Product Type",
    "DATA_PRODUCT_TYPE": "Data Product Type",
    "ENV": "Environment",
}
UNTAGGED = "Untagged"


def tag_label(raw: Column, labels: Mapping[str, str] = TAG_LABELS) -> Column:
    """Reporting label of a raw key: trimmed, looked up without regard to case."""
    clean = F.trim(raw)
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(clean)), clean)


def tagged(dims: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Stack ``(resource type, dimension, natural key, surrogate)`` into
    ``(resource_type_lb, account_cd, workspace_cd, source_cd, tags)``; sentinel rows
    and rows without tags are left out."""
    parts = [
        dim.filter((F.col(id_col) > 0) & F.col("tags").isNotNull()).select(
            F.lit(kind).alias("resource_type_lb"),
            "account_cd",
            "workspace_cd",
            F.col(natural).alias("source_cd"),
            "tags",
        )
        for kind, dim, natural, id_col in dims
    ]
    return reduce(DataFrame.unionByName, parts)


def tag_keys(tag_maps: DataFrame, labels: Mapping[str, str] = TAG_LABELS) -> DataFrame:
    """One row per label: ``tag_key_cd`` and its smallest raw spelling ``raw_key_lb``.

    Labels that differ only in case are one key. Raw keys are made distinct with
    map-side combine first, so the rest works on a handful of rows per key.
    """
    raw = (
        tag_maps.select(F.explode(F.map_keys("tags")).alias("raw"))
        .select(F.trim("raw").alias("raw_key_lb"))
        .distinct()
        .withColumn("label", tag_label(F.col("raw_key_lb"), labels))
    )
    return (
        raw.groupBy(F.upper("label").alias("__u"))
        .agg(F.min_by("label", "raw_key_lb").alias("tag_key_cd"), F.min("raw_key_lb").alias("raw_key_lb"))
        .drop("__u")
    )


def resource_labels(
    resource_tags: DataFrame,
    keys: DataFrame,
    labels: Mapping[str, str] = TAG_LABELS,
    exact_spelling: bool = False,
) -> DataFrame:
    """``(resource_id, tag_key_id, tag_value_lb)`` for tags a resource really carries.

    ``resource_tags`` has ``resource_id`` and a ``tags`` map; ``keys`` the tag-key
    dimension. A resource with several spellings of one key keeps the value of the
    registered spelling, else of the smallest one. ``exact_spelling`` keeps only
    tags spelled exactly as registered.
    """
    pairs = resource_tags.select("resource_id", F.explode("tags").alias("raw", "value"))
    known = keys.filter(F.col("tag_key_id") > 0).select(
        "tag_key_id", F.col("raw_key_lb").alias("__raw"), F.upper("tag_key_cd").alias("__label")
    )
    if exact_spelling:
        hit = pairs.join(known, F.col("raw") == F.col("__raw"))
        return hit.select("resource_id", "tag_key_id", F.col("value").alias("tag_value_lb"))
    hit = pairs.join(known, F.upper(tag_label(F.col("raw"), labels)) == F.col("__label"))
    order = F.struct((F.col("raw") != F.col("__raw")).alias("odd"), F.col("raw").alias("raw"))
    return hit.groupBy("resource_id", "tag_key_id").agg(
        F.min_by("value", order).alias("tag_value_lb")
    )


def tag_bridge(
    resources: DataFrame,
    keys: DataFrame,
    carried: DataFrame,
    fill: str = UNTAGGED,
    slots: int | None = None,
) -> DataFrame:
    """A value for every (resource, tag key); ``fill`` where the resource lacks the key.

    The dense grid is the result asked for. It is built as an equality join: each
    resource sits in one of ``slots`` hash slots (the session's shuffle partitions) and the key list, one row per
    label, is repeated once per slot, so the grid grows in evenly sized pieces. The
    tags a resource carries travel with it as one map, which spares a second join
    at grid size.
    """
    slots = slots or int(resources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = carried.groupBy("resource_id").agg(
        F.map_from_entries(F.collect_list(F.struct("tag_key_id", "tag_value_lb"))).alias("__held")
    )
    left = (
        resources.filter(F.col("resource_id") > 0).select("resource_id").distinct()
        .join(values, "resource_id", "left")
        .withColumn("__slot", F.pmod(F.xxhash64("resource_id"), F.lit(slots)).cast("int"))
    )
    right = keys.filter(F.col("tag_key_id") > 0).select(
        "tag_key_id", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("__slot")
    )
    return left.join(right, "__slot").select(
        "resource_id",
        "tag_key_id",
        F.coalesce(F.try_element_at("__held", F.col("tag_key_id")), F.lit(fill)).alias("tag_value_lb"),
    )


def attach_resource(tag_maps: DataFrame, resources: DataFrame) -> DataFrame:
    """Give each tag map the surrogate of its resource: one join for all types."""
    on = ["resource_type_lb", "account_cd", "workspace_cd", "source_cd"]
    dim = resources.filter((F.col("resource_id") > 0) & ~any_null(on)).select("resource_id", *on)
    return tag_maps.join(dim, on).select("resource_id", "tags")


# ---- sets of resources by label, and what lacks a label by complement ---------

def label_sets(carried: DataFrame) -> DataFrame:
    """``(tag_key_id, bucket_nb, resources)``: the resources, sentinels aside, that carry a label, a bitmap for every 32,768 surrogates.

    Surrogates are dense, so a bitmap of four kilobytes stands for up to 32,768 rows. Sets merge by ``bitmap_or_agg``,
    whatever days or sources they were built from.
    """
    return carried.filter(F.col("resource_id") > 0).groupBy("tag_key_id", F.bitmap_bucket_number("resource_id").alias("bucket_nb")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("resource_id")).alias("resources"))


def _real(resources: DataFrame) -> DataFrame:
    return resources.filter(F.col("resource_id") > 0).select("resource_id").distinct()


def untagged_counts(resources: DataFrame, keys: DataFrame, sets: DataFrame) -> DataFrame:
    """``(tag_key_id, tagged_nb, untagged_nb)`` of every label: all resources less those in its set.

    The grid of resources by labels has a row for each resource that lacks a label; here there is one per label.
    ``sets`` may hold no other surrogates than those of ``resources``.
    """
    held = sets.groupBy("tag_key_id").agg(F.sum(F.bitmap_count("resources")).alias("tagged_nb"))
    total = _real(resources).agg(F.count("*").alias("__all")).withColumn("tag_key_id", F.lit(0).cast("bigint"))
    labels = keys.filter(F.col("tag_key_id") > 0).select("tag_key_id")
    per_label = labels.join(held, "tag_key_id", "left").unionByName(total, allowMissingColumns=True)
    tagged, every = F.coalesce("tagged_nb", F.lit(0)), F.max("__all").over(Window.partitionBy())  # a row per label
    return per_label.select("tag_key_id", tagged.alias("tagged_nb"), (every - tagged).alias("untagged_nb")).filter("tag_key_id > 0")


def without_labels(resources: DataFrame, sets: DataFrame, labels: Sequence[int]) -> DataFrame:
    """``resource_id`` of the resources that carry none of the labels: the labels' sets are put together, one bitmap a
    bucket, and every resource looks up its bit."""
    wanted = sets.filter(F.col("tag_key_id").isin(list(labels))).groupBy("bucket_nb").agg(F.bitmap_or_agg("resources").alias("resources"))
    place = F.bitmap_bit_position("resource_id")
    byte = F.conv(F.hex(F.substring("resources", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("bitmap_bit_position(resource_id) % 8").cast("int")
    held = F.coalesce(F.call_function("getbit", byte, bit) == 1, F.lit(False))
    placed = _real(resources).withColumn("bucket_nb", F.bitmap_bucket_number("resource_id"))
    return placed.join(wanted, "bucket_nb", "left").filter(~held).select("resource_id")


def cost_by_tag(cost: DataFrame, resources: DataFrame, keys: DataFrame, carried: DataFrame, amount: str = "line_cost_usd",
                fill: str = UNTAGGED, by: Sequence[str] = ()) -> DataFrame:
    """``(tag_key_id, tag_value_lb, *by, resources_nb, total_cost)``: cost and resources per label and value, ``fill`` for
    what lacks the label, as the grid would give.

    Cost is reduced to a row per resource and cell of ``by`` first. Only carried tags meet it; what is untagged under a label is the
    whole less what the label covers, in as many rows as there are labels and cells.
    """
    by = list(by)
    per = cost.join(_real(resources), "resource_id", "left_semi").groupBy("resource_id", *by).agg(F.sum(amount).alias("__cost"))
    whole = per.groupBy(*by).agg(F.count("*").alias("__n"), F.sum("__cost").alias("__all"))
    tagged = carried.select("resource_id", "tag_key_id", "tag_value_lb").join(per, "resource_id").groupBy(
        "tag_key_id", "tag_value_lb", *by).agg(F.count("*").alias("resources_nb"), F.sum("__cost").alias("total_cost"))
    covered = tagged.groupBy("tag_key_id", *by).agg(
        F.sum("resources_nb").alias("__held_nb"), F.sum("total_cost").alias("__held"))
    labels = [r[0] for r in keys.filter(F.col("tag_key_id") > 0).select("tag_key_id").collect()]  # columns of the grid
    cells = whole.withColumn("tag_key_id", F.explode(F.array(*map(F.lit, labels)).cast("array<bigint>")))
    same = F.col("c.tag_key_id") == F.col("h.tag_key_id")
    for b in by:
        same = same & F.col(f"c.{b}").eqNullSafe(F.col(f"h.{b}"))
    rest = cells.alias("c").join(covered.alias("h"), same, "left").select(
        "c.tag_key_id", F.lit(fill).alias("tag_value_lb"), *(f"c.{b}" for b in by),
        (F.col("__n") - F.coalesce("__held_nb", F.lit(0))).alias("resources_nb"),
        F.when(F.col("__held").isNull(), F.col("__all")).otherwise(F.col("__all") - F.col("__held")).alias("total_cost"))
    return tagged.unionByName(rest.filter("resources_nb > 0"))

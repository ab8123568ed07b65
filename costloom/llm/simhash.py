"""SimHash near-duplicates through vantage-point trees.

A fingerprint has a bit set if more than half of the text's shingle hashes have it set. Fingerprints are made equal
rows first, so copies cost nothing further on. Pairs within ``RADIUS`` bits are found in two steps.

1. *Shards by distance to block vantages.* The 64 bits are cut into k blocks; of two fingerprints within 4 bits, k - 4 blocks
   at least are at distance 0. Each choice of k - 4 blocks is a table; a fingerprint's own block values are the
   vantage whose distance-0 shard it joins, so pairs that straddle a boundary in one table meet in another. k grows
   with the number of fingerprints (5 tables up to 16 million, then 15, 35, ...), which keeps shards small. Shards are counted; one
   of more than ``LARGEST`` fingerprints, as of documents with a long part in common, is cut again: its pairs differ in
   at most 4 of the bits left, so of 5 blocks of these one at least is at distance 0. This is done until no shard is too large. A tree over all
   64 bits alone does not scale: distances of unlike texts lie at 32 give or take 4, and with a radius of 4 a search
   enters 1.7 of 2 branches at every level.
2. *A vantage-point tree in each shard.* The ball of radius 4 around the vantage is linked at once; the others are split at the
   median distance m. By the triangle inequality only points with distances in (m - 4, m] and (m, m + 4] can make a pair
   across the split, and of those only distances that differ by 4 at most. A split whose two boundaries are
   already one component is pruned. Only tree edges leave a shard, at most one for each point.

Null and empty texts, and texts of white space, have fingerprint zero. Very long texts are hashed in pieces of words. Ties and
repeated rows are equal fingerprints; a component's id is its smallest non-null document id. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..operators.spread import grouped_for_join
from .common import checkpointed, map_texts, row_hash
from .components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
SHARD = 2048
LARGEST = 1 << 13
LEAF = 64
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LONG = 1 << 22
_PIECE = 100_000


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    if len(data) <= _LONG:
        yield data.split()
        return
    words = (m.group() for m in _WORD.finditer(data))
    while piece := list(islice(words, _PIECE)):
        yield piece


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint as an unsigned 64-bit number; 0 if there are no words."""
    import xxhash

    counts, total, tail = np.zeros(64, np.int64), 0, []

    def add(words, count_all):
        nonlocal total
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        stops = [len(line)] if count_all else ends[size - 1:].tolist()
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
        for k in range(0, len(hashes), 1 << 16):
            part = hashes[k:k + (1 << 16)]
            bits = np.unpackbits(part.byteswap().view(np.uint8).reshape(-1, 8), axis=1)
            counts[:] += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for words in _pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        words = tail + words
        if len(words) >= size:
            add(words, False)
            tail = words[-(size - 1):] if size > 1 else []
        else:
            tail = words
    if tail and not total:
        add(tail, True)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str, name: str = "fingerprint", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` and a column with the fingerprint as a signed long."""

    def run(texts):
        import pyarrow as pa

        return [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))]

    return map_texts(docs, text, [T.StructField(name, T.LongType())], run, drop)


def links(points: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Component label of each of some distinct fingerprints (uint64), as positions, by a vantage-point tree."""
    label = np.arange(len(points))

    def merge(which: np.ndarray) -> None:
        held = np.unique(label[which])
        if len(held) > 1:
            label[np.isin(label, held)] = held[0]

    def across(left: np.ndarray, right: np.ndarray) -> None:
        for a in range(0, len(left), 1024):
            some = left[a:a + 1024]
            for b in range(0, len(right), 4096):
                others = right[b:b + 4096]
                if label[some].min() == label[others].max() and label[some].max() == label[others].min():
                    continue
                near = np.bitwise_count(points[some][:, None] ^ points[others][None, :]) <= radius
                for i in np.flatnonzero(near.any(axis=1)):
                    merge(np.append(others[near[i]], some[i]))

    todo = [np.arange(len(points))]
    while todo:
        here = todo.pop()
        if len(here) <= LEAF:
            across(here, here)
            continue
        away = np.bitwise_count(points[here] ^ points[here[0]]).astype(np.int64)
        merge(here[away <= radius])
        split = min(int(np.median(away)), int(away.max()) - 1)
        inner = away <= split
        if min(inner.sum(), (~inner).sum()) < len(here) // 16:
            across(here, here)
            continue
        for near in range(split - radius + 1, split + 1):
            left = here[away == near]
            right = here[~inner & (away <= near + radius)]
            if len(left) and len(right):
                across(left, right)
        todo += [here[inner], here[~inner]]
    return label


def block_masks(count: int, shard: int = SHARD, radius: int = RADIUS) -> list[int]:
    """Masks of the bits that each table compares, as signed longs."""
    k = radius + 1
    while k < 12 and count / 2 ** (64 * (k - radius) / k) > shard:
        k += 1
    block = _blocks(list(range(64)), k)
    return [_signed(sum(block[i] for i in kept)) for kept in combinations(range(k), k - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _blocks(bits: list[int], k: int) -> list[int]:
    edges = [round(len(bits) * i / k) for i in range(k + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(edges, edges[1:])]


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks that cut a shard of ``mask`` further: fingerprints within the radius that agree under ``mask`` agree under one of them."""
    left = [b for b in range(64) if not mask >> b & 1]
    return [_signed(mask & (1 << 64) - 1 | block) for block in _blocks(left, radius + 1)]


def dealt_shards(distinct: DataFrame, masks: list[int], column: str = "fingerprint", largest: int = LARGEST) -> DataFrame:
    """``(table, key, f)``: the fingerprints under every mask (the table), with shards of more than ``largest`` cut by finer masks."""
    if largest < 1 << RADIUS + 1:
        raise ValueError(f"a shard of up to {1 << RADIUS + 1} fingerprints may have too few bits left to be cut")

    def deal(points: DataFrame, under: Column) -> DataFrame:
        return points.select(F.explode(under).alias("table"), "f").select("table", F.col("table").bitwiseAND(F.col("f")).alias("key"), "f")

    done, todo = [], deal(distinct.select(F.col(column).alias("f")), F.array(*map(F.lit, masks)).cast("array<long>"))
    while True:
        # Every shard that is too large has its own row here, and there are fewer than fingerprints / largest in a table.
        over = checkpointed(todo.groupBy("table", "key").count().filter(F.col("count") > largest).select("table", "key"))
        cut = [r["table"] for r in over.select("table").distinct().collect()]
        if not cut:
            return reduce(DataFrame.unionByName, [*done, todo])
        done.append(todo.join(over, ["table", "key"], "left_anti"))
        finer = distinct.sparkSession.createDataFrame([(m, finer_masks(m)) for m in cut], "table long, finer array<long>")
        large = todo.join(over, ["table", "key"]).join(finer, "table")
        todo = checkpointed(deal(large, F.col("finer")).distinct())


def shard_edges(distinct: DataFrame, count: int, column: str = "fingerprint", largest: int = LARGEST) -> DataFrame:
    """Tree edges ``(a, b)`` that join all fingerprints within the radius, from every shard."""
    dealt = dealt_shards(distinct, block_masks(count), column, largest)

    def flush(parts):
        points = np.concatenate(parts).view(np.uint64)
        label = links(points)
        moved = label != np.arange(len(points))
        return points[moved].view(np.int64), points[label[moved]].view(np.int64)

    def run(batches):
        import pyarrow as pa

        held, at = [], None
        out = lambda a, b: pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        for batch in batches:
            table_, key, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("table", "key", "f"))
            if not len(f):
                continue
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (table_[1:] != table_[:-1])) + 1
            found: list[tuple] = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(f)]):
                here = (table_[a], key[a])
                if here != at and held:
                    found.append(flush(held))
                    held = []
                held.append(f[a:b])
                at = here
            if found:
                yield out(*(np.concatenate(x) for x in zip(*found)))
        if held:
            yield out(*flush(held))

    return dealt.repartition("table", "key").sortWithinPartitions("table", "key").mapInArrow(run, "a long, b long")


def groups(prints: DataFrame, column: str = "fingerprint", doc_id: str = "doc_id") -> DataFrame:
    """``(fingerprint, label, component_id)`` of all distinct fingerprints of ``(doc_id, fingerprint)``: the smallest
    fingerprint and the smallest document id of each one's component."""
    distinct = checkpointed(prints.groupBy(column).agg(F.min(doc_id).alias("__first")))
    edges = shard_edges(distinct, distinct.count(), column)
    stars = components(edges)
    labelled = distinct.join(stars.withColumnRenamed("node", column).hint("merge"), column, "left").select(
        column, "__first", F.coalesce("component", column).alias("label"))
    least = grouped_for_join(labelled, ["label"], F.min("__first").alias("component_id"))
    return checkpointed(labelled.join(least.hint("merge"), "label").select(column, "label", "component_id"))


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: fingerprint in hex and component_id."""
    prints = checkpointed(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")), "__text", drop=("__text",)))
    found = groups(prints)
    return prints.join(found, "fingerprint").select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of every group: the smallest document id, null ids last."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), row_hash(docs).alias("row"), F.col(text).alias("__text"))
    prints = checkpointed(with_fingerprint(narrow, "__text", drop=("__text",)))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    kept = prints.join(groups(prints), "fingerprint").groupBy("label").agg(F.min(order).alias("__keep"))
    kept = kept.select(F.col("__keep.doc_id").alias("__id"), F.col("__keep.row").alias("__row"))
    nth = F.row_number().over(W.partitionBy("__id", "__row").orderBy(F.lit(0)))
    whole = docs.select(F.col(doc_id).alias("__id"), row_hash(docs).alias("__row"), F.struct("*").alias("__doc")).withColumn("__nth", nth)
    same = F.col("d.__id").eqNullSafe(F.col("k.__id")) & (F.col("d.__row") == F.col("k.__row"))
    return whole.filter("__nth = 1").alias("d").join(kept.alias("k"), same, "left_semi").select("__doc.*")

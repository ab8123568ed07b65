"""Connected components over an edge table, as rounds of two star contractions.

Every round hangs each node's larger neighbours on its smallest one, then each node and its smaller neighbours
on the smallest of these; a component becomes a star around its smallest node after a few rounds, whatever
its diameter. All grouping is a minimum, reduced before the shuffle; the joins back are splittable, so a hub with
very many neighbours is many tasks' work. Each round is cut off in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators.spread import grouped_for_join
from .common import checkpointed


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` cut from their lineage, with their number and a sum over them, counted while they are written."""
    seen = Observation()
    out = checkpointed(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("hash")))
    return out, (seen.get["n"], seen.get["hash"])


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)``, in any order and repeated as may be, to ``(node, component)``, the smallest node that is reachable.

    Nodes without an edge to another node do not appear. Null ends are dropped. The joins are merge joins: however small a
    side is, the driver builds no hash table for any round.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("real"))
    edges, state = _settled(edges.filter("real").select("a", "b").distinct())
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = grouped_for_join(both, ["a"], F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.filter("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = grouped_for_join(hung, ["a"], F.min("b").alias("m"))
        small = hung.join(low.hint("merge"), "a")
        before = state
        edges, state = _settled(
            small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        if state == before:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

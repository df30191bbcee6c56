"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import HOT, cut, look_up


#: A node with at least 1 in HOT of all edge ends is a hub, so there are at most HOT of them; nor is one with fewer ends than LEAST_ENDS.
LEAST_ENDS = 256


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root: root is the smallest node that edges (a, b) connect with the node.

    Large-star and small-star rounds, each a minimum per node and a join, until the edges no longer change. A minimum
    is summed before its shuffle, and a hub's edges meet its minimum where they lie, so no node's neighbours are
    gathered in one task. Each round is written to the shared folder. Null ends and loops are ignored; nodes without
    an edge don't appear.
    """
    known = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    known = cut(known)
    before = None
    while (now := _signature(known)) != before:
        before = now
        ends = max(LEAST_ENDS, -(-2 * now[0] // HOT))
        both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, F.least(F.col("a"), F.min("b")), ends).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        large = cut(large.distinct())
        small = _with_least(large, F.min("b"), ends).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        known = cut(small.unionByName(large.groupBy("a").agg(F.min("b").alias("b"))).distinct())
    roots = known.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return known.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _with_least(edges: DataFrame, least: Column, ends: int) -> DataFrame:
    """a, b and the least of a's edges."""
    return look_up(edges, edges.groupBy("a").agg(least.alias("least"), F.count("*").alias("ends")), "a", "ends", ends)


def _signature(edges: DataFrame) -> tuple:
    """Two equal edge sets have the same; it takes one small row to the driver."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())

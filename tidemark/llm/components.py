"""Connected components of an edge table, by alternating stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): a large
star links each node's greater neighbours to its least neighbour, a small star
its lesser ones. Each round is two grouped minima and two joins, whose skewed
side Spark can split; nothing is collected. Each round is written to the shared
folder, so that a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import spread_join, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        spread_join(around.where("b > a"), least, ["a"])
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the greater node ``a`` to the lesser ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    return (
        spread_join(edges, least, ["a"])
        .select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes with edges.

    ``edges`` has columns ``a`` and ``b`` of one type, in any order, with
    repeats and loops or without; nodes that have loops only are left out.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    sign = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003))
    before, after = None, now.agg(sign).first()[0]
    while before != after:
        before = after
        now = stored(_small_star(_large_star(now)), "edges")
        after = now.agg(sign).first()[0]
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""Connected components by alternating stars, one shuffle join per step and no lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; ``root`` is the smallest node it reaches.

    Each round hangs a node's larger neighbours onto its smallest one, then all of a node's smaller
    neighbours, until nothing changes; a hub's neighbours are rows, not a list. The edges
    are stored after each round in the shared folder. Loops and repeated edges do no harm.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                F.least("a", "b").alias("b")).distinct(), "edges")
    before, now = None, _signature(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select("b", "m").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "edges")
        before, now = now, _signature(edges)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

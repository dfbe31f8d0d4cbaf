"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.shared import landed


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links of bigint nodes to ``(node, root)``; root is the smallest node reachable.

    Every node that has a link to another node gets one row, but for the roots themselves.
    Each round hangs the larger neighbours of a node, then the smaller ones, under their
    smallest; the number of rounds grows with the logarithm of the longest chain. Neighbours
    are never gathered: minima combine map-side and a node with very many links is a skewed
    join side, which Spark splits. Each round is a written table, so a lost executor costs one
    round at most.
    """
    def normal(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    now = landed(normal(edges), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(below.select("u", F.col("m").alias("v")))
        now = landed(normal(small), "links")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

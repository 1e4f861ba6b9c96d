"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialfold.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b), root being the smallest
    node of the component, for nodes that aren't roots themselves.

    Each round hangs the larger neighbours of a node, then the smaller ones,
    under its smallest neighbour.  The number of rounds grows with the
    logarithm of the component's size; each is two joins whose hot keys
    adaptive execution splits, cut by a checkpoint.  Ends when a round changes
    no edge."""
    e = cut(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(low.select("u", F.col("m").alias("v")).unionByName(moved).distinct())

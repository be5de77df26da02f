"""Connected components of an edge table, by alternating large and small stars.

Each round hooks every node's larger neighbours to its smallest one and then
flattens the trees. The edges shrink to one star per component after a number
of rounds that grows with the logarithm of the longest path. Links stay in
Spark; the driver sees one count and one checksum per round.

Every table of a round is written, so that the join sides come from their own
exchanges and adaptive execution can split a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes that edges (``a``, ``b``) name.

    Repeated edges, both directions and loops are fine; NULL ends are not links.
    Nodes without an edge are not in the result.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    stars = scratch.write("stars", pairs.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct())
    before = None
    while not stars.isEmpty():
        both = stars.select(F.col("child").alias("node"), F.col("parent").alias("other")).unionByName(
            stars.select(F.col("parent").alias("node"), F.col("child").alias("other"))
        )
        least = scratch.replace("least", both.groupBy("node").agg(F.least("node", F.min("other")).alias("to")))
        larger = both.where("other > node").join(least, "node").select(F.col("other").alias("child"), F.col("to").alias("parent"))
        large = scratch.replace("large", larger.distinct())
        lowest = scratch.replace("lowest", large.groupBy("child").agg(F.min("parent").alias("to")))
        hooked = large.join(lowest, "child").where("parent != to").select(F.col("parent").alias("child"), F.col("to").alias("parent"))
        kept = lowest.select("child", F.col("to").alias("parent"))
        stars = scratch.replace("stars", hooked.unionByName(kept).distinct())
        after = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)")).alias("sum")).first()
        if after == before:
            break
        before = after
    roots = stars.select(F.col("parent").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(roots)

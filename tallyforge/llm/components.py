"""Connected components by alternating large-star and small-star steps over an edge table.

Every step is an aggregation (minimum of the neighbours, partial before the shuffle) and a join back to the edges, so a
node with very many neighbours is never gathered in one group; a skewed join partition is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.corpus import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang the neighbours of every node on their minimum; edges are (a, b) with a > b."""
    if small:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    larger = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    return larger.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def connected_components(links: DataFrame, first: str, second: str) -> DataFrame:
    """(node, root) for every node of a link, root being the smallest node that it reaches.

    Links are rows of two comparable ids; loops, repeats and null ends are ignored. No link gives no row. The number of
    rounds grows with the logarithm of the longest chain; each round is written to the shared folder.
    """
    pair = links.where(F.col(first) != F.col(second))
    edges = stored(
        pair.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).distinct(), "edges"
    )
    mark = None
    while True:
        edges = stored(_star(_star(edges, small=False), small=True), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        mark = now

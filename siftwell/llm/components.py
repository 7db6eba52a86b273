"""Connected components by alternating large-star and small-star steps.

Each round is two aggregations and joins over the edges and halves distances; rounds go on until
the edges no longer change. Edges are stored in the shared folder after each round, so a lost
executor costs one round at most; the round before is then deleted. Only a count and a checksum
come to the driver.

Edge cases: loops and repeated edges do no harm; without edges the result is empty; null ends are
not allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.sources.workspace import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges have ``a > b``."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(lowest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(lowest.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of all nodes that are not the smallest of their component.

    ``edges`` has long columns ``a, b``; loops and repeats do no harm.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, path = materialize(ordered.distinct(), "links")
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    last = current.agg(F.count("*"), checksum).first()
    while last[0]:
        before = path
        current, path = materialize(_small_star(_large_star(current)).distinct(), "links")
        discard(edges.sparkSession, before)
        found = current.agg(F.count("*"), checksum).first()
        if found == last:
            break
        last = found
    return current.select(F.col("a").alias("node"), F.col("b").alias("label"))

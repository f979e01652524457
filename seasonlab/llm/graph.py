"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.common import stored


def _nearest(links: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself, beside all its links."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("at", "m").alias("m"))
    return links.join(least, F.col("u") == F.col("at")).drop("at")


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node hangs on one other, or others hang on it."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    found = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.sum("holds").alias("holds"))
    return found.where("hangs > 1 OR (hangs = 1 AND holds > 0)").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): each linked node with the smallest node that it can reach.

    ``links`` has long columns a and b. Large and small stars in turn: every node hands
    its larger neighbours, then its smaller ones, to the smallest node around it. Each
    step is a grouping, combined before the shuffle, and a join; the links shrink to
    stars, whose middle is the smallest node. Links of a node to itself and repeated
    ones do no harm.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    for _ in range(rounds):
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        joined = _nearest(large.where("u > v"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u > v").distinct(), "links")
    raise RuntimeError(f"components did not settle in {rounds} rounds")

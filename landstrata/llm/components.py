"""Connected components of a distributed list of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstrata.session import materialise_observing


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of `links(a, b)`, the smallest node that it reaches.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node seen
    there. The links of a node are reduced to their minimum before they are shuffled, and joined back
    with a join that splits hot nodes. Rounds are cut by checkpoints and grow with the logarithm of
    the longest path. Null ends and links of a node to itself are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges, seen = _stored(edges)
    while seen["edges"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        hung = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        hung = hung.distinct()
        lowest = hung.groupBy("a").agg(F.min("b").alias("low"))
        near = hung.join(lowest, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges, now = _stored(near.unionByName(lowest.withColumnRenamed("low", "b")).distinct())
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The links in shared storage, with their number and a sum that tells two sets of links apart."""
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return materialise_observing(edges, edges=F.count(F.lit(1)), mark=mark)

"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.session import durable


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge at most to a lesser one, and these have none: then the edges name the components."""
    twice = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    inner = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
    return twice.unionAll(inner).isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every end of an edge; ``component`` is the least node connected to it.

    Each step replaces edges by edges to the least neighbour, with a minimum for each node instead of a list of its neighbours, so
    a node of any degree is handled by partial aggregation. The number of rounds grows with the logarithm of the longest
    path. Edges with a null end and self edges only name their node.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    nodes = pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).where("node is not null").distinct()
    oriented = pairs.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
    current = durable(oriented)
    while not _stars(current):
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = durable(small.unionAll(near.select("u", F.col("m").alias("v"))).distinct())
    return nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )

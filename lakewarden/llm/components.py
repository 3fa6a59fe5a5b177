"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import saved


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it can reach.

    Each step links a node's neighbours to the smallest among them, first the larger ones, then all
    (large star, small star). The links are written after each step, so lineage stays short; a node
    with many links is combined in map tasks, as only minima are taken.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = saved(ordered.where(F.col("a") != F.col("b")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = saved(_star(both, larger=True), "links")
        edges = saved(_star(edges, larger=False), "links")
        # Equal counts and sums of two hashes: nothing changed.
        new = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a))")).first()
        if new == state:
            break
        state = new
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("hub"), F.least("hub", "least").alias("least"))
    joined = edges.join(least, edges["a"] == least["hub"])
    if larger:
        joined = joined.where(F.col("b") > F.col("a"))
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("hub").alias("a"), F.col("least").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()

"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is joined to the node's smallest neighbour or itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are joined to the smallest of them; u > v in every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """node and component (smallest node reachable) of every node on an edge (a, b).

    Each step's edges are a table of their own, so no step depends on lost
    executors. Ends when no step changes an edge: then every edge joins a
    node to the smallest of its component. The joins' other side has one row a
    node, so Spark can split a node with many edges.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = stored(edges, name), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        edges = stored(_small_star(_large_star(edges)), name)

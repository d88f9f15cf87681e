"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetweave.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is the smallest node reachable.

    Alternating stars: every node's larger neighbours, then its smaller ones, are
    tied to its smallest neighbour, until each component is one star. Minima are
    aggregated before they are shuffled, rounds are written tables, and a node
    with very many edges is an ordinary skewed join.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    while not _stars(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionAll(least.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node is a root, or a leaf of one root."""
    leaves = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("root"))
    roles = leaves.unionAll(roots).groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root"))
    return roles.where("leaf + root > 1").isEmpty()

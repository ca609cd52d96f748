"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """Every larger neighbour of a node moves to the least of node and neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written: Spark can then split the join at a node with many neighbours
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)
    moved = both.join(least, "a").where(F.col("b") > F.col("a"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node moves to the least one, and so does the
    node.  A node has few smaller neighbours after a large star."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.explode(F.array(
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
    return moved.where("a != b").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour at most, which has none itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).isEmpty()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``component`` (its least node) for every node in ``edges``
    (columns ``a``, ``b`` of one orderable type; loops are ignored).

    Edges never grow in number; each step is written to the shared folder, so
    lost executors cost one step.  Ends when every component is a star around
    its least node, after about the logarithm of the longest chain."""
    e = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _is_stars(e):
        e = written(_small_star(written(_large_star(e, f"{name}-least"), name)), name)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

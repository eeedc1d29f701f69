"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import written


def star(edges: DataFrame, both: bool) -> DataFrame:
    """Point every neighbour (``both``: the larger ones, else the smaller ones and the node itself)
    of a node at the smallest of its neighbours and itself."""
    if both:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        seen = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = seen.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    joined = seen.join(least, "u")
    if both:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge, from columns a and b; the root is the component's smallest node.

    Every round writes its edges to the shared folder, so lost executors repeat one round at most.
    """
    edges = written(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = written(star(star(edges, both=True), both=False), "edges")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())

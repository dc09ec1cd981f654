"""Connected components by alternating large and small stars, a number of rounds logarithmic in the nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from churnflow.llm.columns import stored


def _only_stars(edges: DataFrame) -> bool:
    """Whether each node either points to one node, or is pointed to."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in")).filter("out + in > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of ``edges`` (a, b); a component is named by its least node.

    Null ends and loops are left out; no edges give no rows. A node with very many neighbours is a hot key of a join of
    its edges with its least neighbour, one row: narrow rows of two names, which meet in one task.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "edges")
    while not _only_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.union(least).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())

"""Connected components of a table of links, without bringing nodes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.session import written


def components(links: DataFrame) -> DataFrame:
    """node, component for all ends of links (a, b): the smallest node that links reach.

    Every round hangs each node below its smallest neighbour, follows these parents to their roots by
    doubling, and keeps only links between different roots. Both loops end after about as many steps
    as the logarithm of the number of nodes. Loops, repeated links and an empty table are fine.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
        parents = written(parents.select("node", F.least("node", "_least").alias("parent")), "parents")
        roots = rooted(parents)
        if labels is None:
            labels = roots.select("node", F.col("parent").alias("component"))
        else:
            labels = followed(labels, roots)
        labels = written(labels, "labels")
        a, b = roots.select(F.col("node").alias("a"), F.col("parent").alias("pa")), roots.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        left = edges.join(a, "a").join(b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).filter("a <> b").distinct()
        edges = written(left, "links")
        if edges.isEmpty():
            return ends.join(labels, "node").select("node", "component")


def followed(labels: DataFrame, roots: DataFrame) -> DataFrame:
    """Labels moved on to the roots of the last round, where they took part in it."""
    moved = roots.select(F.col("node").alias("component"), "parent")
    return labels.join(moved, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))


def rooted(parents: DataFrame) -> DataFrame:
    """Parents replaced by roots: parents of parents until nothing changes."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_root"))
        joined = parents.join(above, "parent").select("node", F.col("_root").alias("parent"), (F.col("_root") != F.col("parent")).alias("_moved"))
        parents = written(joined, "parents")
        if not parents.filter("_moved").limit(1).count():
            return parents.select("node", "parent")
        parents = parents.select("node", "parent")

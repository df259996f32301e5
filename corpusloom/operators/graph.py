"""Hierarchies and prerequisite graphs by joins that double the paths known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.scratch import fixed


def ancestors(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(child, ancestor, depth) for every ancestor of every node at every distance, depth 1 being the parent.

    Each round joins the paths of the greatest length known with all known ones, which doubles that length, and is written to
    the shared folder; a hierarchy of n levels takes log2(n) rounds.  A graph with a cycle is an error, seen as soon as a node
    is its own ancestor.  Null ends and repeated edges do not count.
    """
    paths = fixed(edges.select(F.col(child).alias("c"), F.col(parent).alias("a"), F.lit(1).alias("depth")).where("c is not null and a is not null").distinct())
    length = 1
    while True:
        if not paths.where("c = a").isEmpty():
            raise ValueError("the graph has a cycle")
        longest = paths.where(F.col("depth") == length).select("c", F.col("a").alias("over"))
        if longest.isEmpty():
            return paths.select(F.col("c").alias(child), F.col("a").alias("ancestor"), "depth")
        further = longest.join(paths.select(F.col("c").alias("over"), "a", "depth"), "over").select("c", "a", (F.col("depth") + length).alias("depth")).distinct()
        paths = fixed(paths.unionByName(further))
        length *= 2


def prerequisite_levels(nodes: DataFrame, edges: DataFrame, node: str, child: str, parent: str) -> DataFrame:
    """(node, level): the length of the longest path to a node without prerequisites, which has level 0."""
    longest = ancestors(edges, child, parent).groupBy(child).agg(F.max("depth").alias("level"))
    return nodes.select(node).distinct().join(longest.withColumnRenamed(child, node), node, "left").select(node, F.coalesce("level", F.lit(0)).alias("level"))


def cyclic_nodes(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """Nodes (column ``node``) that lie on a cycle or lead to one only: what is left when nodes without parents are taken away
    again and again.  Empty for a graph that can be ordered."""
    left = fixed(edges.select(F.col(child).alias("c"), F.col(parent).alias("p")).where("c is not null and p is not null").distinct())
    while True:
        kept = fixed(left.join(left.select(F.col("c").alias("p")).distinct(), "p", "left_semi").select("c", "p"))
        if kept.count() == left.count():
            return kept.select(F.col("c").alias("node")).distinct()
        left = kept

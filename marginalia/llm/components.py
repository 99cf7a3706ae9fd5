"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is two shuffles over narrow rows and is written to the shared folder, so lineage stays
short and a lost executor costs one step. No component is ever gathered in one place: minima are
combined in the map tasks and a hub's edges are rows of a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.storage import discard, stage


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour instead."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    root = _least_neighbour(both).select("u", F.least("u", "least").alias("root"))
    larger = both.filter("v > u").join(root, "u")
    return larger.select(F.col("v").alias("u"), F.col("root").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    root = _least_neighbour(edges).withColumnRenamed("least", "root")
    rest = edges.join(root, "u").filter("v <> root")
    moved = rest.select(F.col("v").alias("u"), F.col("root").alias("v"))
    return moved.unionByName(root.select("u", F.col("root").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every larger end has one edge, to a node that has none: each component is a star."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(``u``, ``root``) for every node of ``edges`` (long ``u``, ``v``) that has a smaller one.

    ``root`` is the least node of the component; loops and repeated edges are allowed. Nodes
    that are their own root do not appear. An empty table gives an empty table.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stage(edges, "edges")
    while not _settled(edges):
        done, edges = edges, stage(_small_star(_large_star(edges)), "stars")
        discard(done)
    return edges.select("u", F.col("v").alias("root"))


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components of earlier links, given by their ``roots``, and further staged ``links`` together."""
    if links.isEmpty():
        return roots
    return components(roots.select("u", F.col("root").alias("v")).unionByName(links.select("u", "v")))

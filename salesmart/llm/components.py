"""Connected components by alternating large and small stars.

Each round joins and aggregates the edge list; it is written to the shared
folder in between, and only counts come to the driver.  The number of rounds
grows with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node with an edge to another node, the smallest node of its component."""
    edges = staged(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    while not _is_forest_of_stars(edges):
        edges = staged(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """No node hangs on two others, and none that hangs on another has any below it."""
    inner = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi")
    twice = edges.groupBy("u").count().where("count > 1")
    return inner.isEmpty() and twice.isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, or to itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written so that the join below is between two plain exchanges, whose hot keys can be split
    lowest = staged(both.groupBy("u").agg(F.min("v").alias("m")), "lowest")
    return (
        both.where("v > u")
        .join(lowest, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    edges = staged(edges, "large")
    lowest = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "lowest")
    moved = edges.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()

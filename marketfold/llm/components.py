"""Connected components of links between numbered nodes, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import staged


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it is connected with.

    Every round hangs the larger neighbours of a node, then its smaller ones, below its smallest
    neighbour, until every edge leads straight to the smallest node of its component. Rounds grow with
    the logarithm of the longest path. A node with very many links is aggregated before the shuffle,
    and its join back is one that adaptive execution may split.
    """
    edges = staged(_ordered(links.select("a", "b")))
    while not _are_stars(edges):
        both_ways = edges.select("a", "b").union(edges.select("b", "a"))
        larger = staged(_star(both_ways, larger_only=True))
        edges = staged(_ordered(_star(larger, larger_only=False)))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(roots.distinct())


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links from the larger node ``a`` to the smaller ``b``."""
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return links.filter("a <> b").select(larger, smaller).distinct()


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    lowest = staged(lowest.select("a", F.least("a", "low").alias("low")))
    moved = edges.join(lowest, "a")
    if larger_only:
        return moved.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    rest = moved.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return rest.union(lowest.select("a", F.col("low").alias("b")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge leads straight to the smallest node of its component.

    With edges from larger to smaller nodes that is so if no node has two edges down, or edges both
    down and up.
    """
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return seen.filter("down + up > 1").isEmpty()

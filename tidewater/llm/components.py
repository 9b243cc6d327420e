"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written_small as written


def _least(edges: DataFrame) -> DataFrame:
    """(a, m): the smallest of a node and its partners. Written, so that the join with the
    edges has two plain shuffles and Spark can split the rows of a hub."""
    return written(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "components-least")


def _linked(a, b, edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b")


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and on none that hangs itself."""
    one = F.lit(1)
    ends = edges.select(F.col("a").alias("node"), one.alias("hangs"), F.lit(0).alias("top")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), one.alias("top"))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("top").alias("top"))
    return nodes.agg(F.count_if((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("top") > 0)))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (x, y): the smallest node it can reach.

    A large star hangs the larger partners of each node onto its smallest one, a small
    star the smaller partners and the node itself. In the end every node hangs on one
    other, which hangs on none: the smallest of its component.
    """
    edges = written(_linked(F.col("x"), F.col("y"), links).distinct(), "components")
    while not _only_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").where("b > a")
        edges = written(_linked(F.col("b"), F.col("m"), large).distinct(), "components")
        least = _least(edges)
        small = edges.join(least, "a")
        edges = written(_linked(F.col("b"), F.col("m"), small).unionByName(_linked(F.col("a"), F.col("m"), least)).distinct(), "components")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()

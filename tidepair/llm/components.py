"""Connected components by alternating large and small stars, as joins and minima.

A node's smallest neighbour is a map-side combined minimum; a node with very many
neighbours is a skewed side of an equi-join, which adaptive execution splits.  New
links go on from the stars of those before; nothing starts again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b) with b < a.  Large: each larger neighbour of a node goes to the
    smallest of its neighbourhood.  Small: the node and its smaller neighbours do."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def contracted(edges: DataFrame | None, links: DataFrame) -> DataFrame:
    """One step towards stars from the ``edges`` of a step before and new ``links`` (a, b),
    as a table that takes the place of both."""
    new = (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    every = new if edges is None else edges.select("a", "b").union(new)
    out = materialize(_star(_star(every, True), False), "edges")
    if edges is not None:
        discard(edges)
    return out


def labels(edges: DataFrame) -> DataFrame:
    """(node, component): a node of the component of each, the smallest one once ``edges`` are stars."""
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))


def are_stars(edges: DataFrame) -> bool:
    """Whether each node has one neighbour before it or is one itself, not both."""
    nodes = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    sums = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.filter("up > 1 OR up + down > 1").limit(1).count() == 0


def united(edges: DataFrame) -> DataFrame:
    """``edges`` as stars."""
    while not are_stars(edges):
        edges = contracted(edges, edges.limit(0))
    return edges


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of ``edges`` (a, b)
    that are not the smallest of their component."""
    return labels(united(contracted(None, edges)))

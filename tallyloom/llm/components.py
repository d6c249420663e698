"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """(node, least): the smaller of each node and its least partner.

    ``node`` is the maximum of the group's own key. It therefore counts as a new
    column, both sides of the following join are exchanged, and adaptive
    execution can split the pairs of a node with very many partners.
    """
    grouped = pairs.groupBy("u").agg(F.max("u").alias("node"), F.min("v").alias("least"))
    return grouped.select("node", F.least("node", "least").alias("least"))


def _hook(pairs: DataFrame, keep: Column) -> DataFrame:
    """Link the kept partners of each node to the node's least neighbour.

    Sort-merge joins by request: a broadcast in every round would fill the driver's memory.
    """
    least = _least_neighbour(pairs).hint("merge")
    return pairs.join(least, pairs["u"] == least["node"]).where(keep).select(
        F.col("v").alias("a"), F.col("least").alias("b")
    )


def _round(edges: DataFrame) -> DataFrame:
    """One pass of linking larger, then smaller partners to the least of a neighbourhood."""
    either = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    large = _hook(either, F.col("v") > F.col("u")).distinct()
    down = large.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    least = _least_neighbour(down)
    small = _hook(down, F.col("v") > F.col("least")).union(
        least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    )
    return small.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that some edge ``(a, b)`` touches.

    The component is its smallest node. Each round halves the depth of the trees
    in which nodes hang below smaller ones, in work that is linear in the edges.
    All rounds are joins and aggregates; only one checksum row reaches the driver.
    Loops, repeated edges and edges with a null end are ignored.
    """
    current = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

    def summary(frame: DataFrame):
        return frame.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    before = summary(current)
    while before[0]:
        current = stored(_round(current))
        after = summary(current)
        if after == before:
            break
        before = after
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)

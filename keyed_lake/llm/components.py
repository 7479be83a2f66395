"""Connected components of a table of links, by repeated contraction in a random order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written


def _rank(node: str) -> Column:
    """Orders nodes at random, but always alike."""
    return F.struct(F.xxhash64(node).alias("hash"), F.col(node).alias("node"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) of every node that occurs in a link with another node.

    In each round every node takes as parent whichever of itself and its neighbours has the smallest hash; then the links
    between different parents are the next round's. Hashes fall from node to parent, so there is no circle. As they know
    nothing of the order of the ids, a chain loses a share of its nodes in every round, whatever its ids; 2,000 nodes in
    id order take as many rounds as in any other. Each round is a written table; a node with many links is aggregated
    before it is shuffled, and joins are between stored tables, which lets Spark split it. Links of a node with itself
    and repeated ones count for nothing, and null nodes have no links.
    """
    edges = written(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "links"
    )
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min(_rank("b")).alias("least"))
        parent = written(parent.select(F.col("a").alias("node"), F.least(_rank("a"), "least")["node"].alias("parent")), "parents")
        rounds.append(parent)
        left, right = (parent.select(F.col("node").alias(x), F.col("parent").alias(f"p{x}")) for x in "ab")
        up = edges.join(left, "a").join(right, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = written(up.where("a < b").distinct(), "links")
    out = None
    for parent in reversed(rounds):
        if out is None:
            out = parent.select("node", F.col("parent").alias("component"))
            continue
        known = out.select(F.col("node").alias("parent"), "component")
        out = written(
            parent.join(known, "parent", "left").select("node", F.coalesce("component", "parent").alias("component")),
            "components",
        )
    if out is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    names = written(out.groupBy("component").agg(F.min("node").alias("least")), "least-nodes")  # a row a component
    return out.join(names, "component").select("node", F.col("least").alias("component"))

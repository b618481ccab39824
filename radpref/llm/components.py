"""Connected components of a table of links, by repeated contraction. Nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radpref.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of ``links``: ``a, b``.

    Each round lets every node take the least of itself and its neighbours, moves all links to what their
    ends took, and drops loops and repeats; what a node took is looked up again among the takers of the
    later rounds. Links shrink at least geometrically on chains and stars alike. Nulls link nothing.
    """
    edges = cut(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        took = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("to")), "taken")
        rounds.append(took)
        a, b = took.select(F.col("node").alias("a"), F.col("to").alias("x")), took.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = edges.join(a, "a").join(b, "b").where("x != y")
        edges = cut(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    last = rounds.pop()
    while rounds:
        up = last.select(F.col("node").alias("to"), F.col("to").alias("top"))
        last = cut(rounds.pop().join(up, "to", "left").select("node", F.coalesce("top", "to").alias("to")), "taken")
    return last.select("node", F.col("to").alias("component"))

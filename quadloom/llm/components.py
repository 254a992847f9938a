"""Connected components of a graph of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.llm.common import cut


def components(links: DataFrame, label: str) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of links (a, b).

    Each round leads every node to its smallest neighbour and joins the nodes
    that are led to one place, until no link is left; then the steps are put
    together.  Links and steps are written in every round.  A node with very many
    links is one row in the smaller side of each join.
    """
    left = cut(links.where("a <> b").select("a", "b").distinct(), label)
    steps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b"))
        step = cut(near.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), label)
        steps.append(step)
        moved = left.join(step, left["a"] == step["node"]).select(F.col("to").alias("a"), "b")
        moved = moved.join(step, moved["b"] == step["node"]).select("a", F.col("to").alias("b"))
        # one direction and no link within a place
        left = cut(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label)
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0].select("node", F.col("to").alias("component"))
    for step in steps[1:]:
        nxt = step.select(F.col("node").alias("_node"), "to")
        found = found.join(nxt, found["component"] == nxt["_node"], "left")
        found = found.select("node", F.coalesce("to", "component").alias("component"))
    return cut(found, label)

"""Transitive closure and reachability over an edge table.

Both loops keep their state in tables under the shared folder: every round adds
only the pairs it found, so nothing is rewritten and the lineage stays short.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.session import materialize, scratch_path

PAIRS = "x string, y string"


def _compose(left: DataFrame, right: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Pairs (x, z) with (x, y) on the left and (y, z) on the right."""
    a = left.select(*by, F.col("x").alias("a_x"), F.col("y").alias("mid"))
    b = right.select(*by, F.col("x").alias("mid"), F.col("y").alias("b_y"))
    return (
        a.join(b, [*by, "mid"])
        .select(*by, F.col("a_x").alias("x"), F.col("b_y").alias("y"))
        .distinct()
    )


def _without(pairs: DataFrame, known: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return pairs.join(known, [*by, "x", "y"], "left_anti")


def transitive_closure(edges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct pairs (x, y) joined by a path of one or more edges, within each ``by``.

    After round k all pairs up to distance 2^k are known and those at exactly 2^k
    are marked ``far``.  The next round follows any known pair by a far one.  Every
    pair is stored once, at its shortest distance, so cycles end by themselves and
    the number of rounds is logarithmic in the longest distance.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, "closure")
    cols = [*by, "x", "y"]
    found = [f"{root}/round-0"]
    last = materialize(edges.select(*cols).distinct().withColumn("far", F.lit(True)), found[0])
    schema = last.schema

    def read(paths: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*paths)

    while True:
        step = last.where("far")
        if step.isEmpty():
            return read(found).select(*cols)
        left = last
        if len(found) > 1:
            left = left.union(read(found[:-1]).withColumn("far", F.lit(False)))
        a = left.select(*by, F.col("x").alias("a_x"), F.col("y").alias("mid"), "far")
        b = step.select(*by, F.col("x").alias("mid"), F.col("y").alias("b_y"))
        longer = a.join(b, [*by, "mid"]).select(*by, F.col("a_x").alias("x"), F.col("b_y").alias("y"), "far")
        # reached by a shorter way as well: not far
        longer = longer.groupBy(*cols).agg(F.bool_and("far").alias("far"))
        path = f"{root}/round-{len(found)}"
        last = materialize(_without(longer, read(found), by).select(*cols, "far"), path)
        found.append(path)


# Edges followed per round of ``reachable``.
HOPS = 4


class _Walk:
    """What some seeds reach, a few edges further with every round; each pair is stored once."""

    def __init__(self, edges: DataFrame, seeds: DataFrame, root: str):
        self.edges, self.root, self.found = edges, root, []
        start = seeds.select("x").distinct()
        self.frontier = start.select("x", F.col("x").alias("y"))
        self.spark = edges.sparkSession

    def step(self) -> None:
        """Follow ``HOPS`` edges; only pairs first met at the last one go on from there."""
        hops, at = [], self.frontier
        for n in range(1, HOPS + 1):
            at = _compose(at, self.edges, ())
            hops.append(at.withColumn("hop", F.lit(n)))
        new = reduce(DataFrame.union, hops).groupBy("x", "y").agg(F.min("hop").alias("hop"))
        if self.found:
            new = _without(new, self.pairs(), ())
        path = f"{self.root}/round-{len(self.found)}"
        self.frontier = materialize(new, path).where(F.col("hop") == HOPS).select("x", "y")
        self.found.append(path)

    def pairs(self) -> DataFrame:
        return self.spark.read.schema(PAIRS).parquet(*self.found)


def reachable(edges: DataFrame, seeds: DataFrame, copied: bool = True) -> DataFrame:
    """Distinct pairs (x, y): ``y`` is one or more edges away from the seed ``x``.

    ``seeds`` has a column ``x``.  Only what the seeds reach is computed, in rounds of
    ``HOPS`` edges.  The edges are read at every hop: ``copied`` says whether they are
    written once before (right when they come from joins) or read where they are.
    """
    root = scratch_path(edges.sparkSession, "reach")
    edges = edges.select("x", "y")
    walk = _Walk(materialize(edges, f"{root}/edges") if copied else edges, seeds, root)
    while True:
        walk.step()
        if walk.frontier.isEmpty():
            return walk.pairs()


def between(edges: DataFrame, starts: DataFrame, ends: DataFrame, copied: bool = True) -> DataFrame:
    """Distinct pairs (x, y) of a start and an end (columns ``x``) that is one or more edges away.

    Two walks, one along the edges from the starts and one against them from the ends; the
    one whose frontiers had fewer pairs so far goes on.  The first that has nowhere to go knows
    all pairs, so the work follows the side that reaches less, whichever that is.
    """
    root = scratch_path(edges.sparkSession, "between")
    edges = edges.select("x", "y")
    edges = materialize(edges, f"{root}/edges") if copied else edges
    starts, ends = (materialize(side.select("x").distinct(), f"{root}/{name}") for side, name in ((starts, "starts"), (ends, "ends")))
    against = edges.select(F.col("y").alias("x"), F.col("x").alias("y"))
    walks = [_Walk(edges, starts, f"{root}/from"), _Walk(against, ends, f"{root}/to")]
    sizes = [walk.frontier.count() for walk in walks]
    spent = list(sizes)
    while all(sizes):
        side = 0 if spent[0] <= spent[1] else 1
        walks[side].step()
        sizes[side] = walks[side].frontier.count()
        spent[side] += sizes[side]
    forward = sizes[0] == 0
    walk, others = (walks[0], ends) if forward else (walks[1], starts)
    if not walk.found:
        return starts.select("x", F.col("x").alias("y")).limit(0)
    pairs = walk.pairs().join(others.select(F.col("x").alias("y")), "y", "left_semi")
    return pairs.select("x", "y") if forward else pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))


def with_identity(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add (n, n) for every node: paths of length zero."""
    same = nodes.select(F.col("x"), F.col("x").alias("y"))
    return reduce(DataFrame.union, [pairs.select("x", "y"), same]).distinct()

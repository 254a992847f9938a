"""Stored quads as patterns and scans see them: constants choose the folders that are read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.model import OBJECT, Term, term_equals


@dataclass(frozen=True)
class StoredQuads:
    """``read(predicates=, copy=, keys=)`` gives stored quads; ``copies`` are the orders there are besides the predicate's.

    ``catalogue`` (p, g) says in which graphs a predicate may be; with it a triple of a
    predicate that only one graph has is known not to repeat in another one.
    """

    read: Callable[..., DataFrame]
    copies: tuple[str, ...] = ()
    catalogue: Callable[[], DataFrame] | None = None

    @property
    def df(self) -> DataFrame:
        return self.read()

    def match(
        self, s: str | None = None, p: str | None = None, o: Term | None = None, graphs: list[str] | None = None
    ) -> tuple[DataFrame, bool]:
        """Matching quads, and whether all of them come from a single graph.

        A constant subject is looked up in the order by subject, else a constant object in
        the one by object, else a constant predicate in the store's own.
        """
        if s is not None and "s" in self.copies:
            df = self.read(copy="s", keys=[s])
        elif o is not None and "o" in self.copies:
            df = self.read(copy="o", keys=[o.value])
        elif p is not None:
            df = self.read(predicates=[p])
        else:
            df = self.read()
        for slot, value in (("s", s), ("p", p)):
            if value is not None:
                df = df.where(F.col(slot) == value)
        if o is not None:
            df = df.where(term_equals({c: F.col(c) for c in OBJECT}, o))
        if graphs is not None:
            df = df.where(F.col("g").isin(graphs))
        return df, (graphs is not None and len(graphs) == 1) or self._in_one_graph(p, graphs)

    def _in_one_graph(self, p: str | None, graphs: list[str] | None) -> bool:
        """Does the catalogue leave no triple two graphs to be in?"""
        if self.catalogue is None:
            return False
        pairs = self.catalogue()
        if p is not None:
            pairs = pairs.where(F.col("p") == p)
        if graphs is not None:
            pairs = pairs.where(F.col("g").isin(graphs))
        return pairs.groupBy("p").agg(F.count_distinct("g").alias("n")).where("n > 1").isEmpty()

"""Set-semantic updates: every operation takes a state and returns a new one.

Nothing is written here; ``sources.snapshots`` stores the changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.quad_columns import statements
from quadloom.model import OBJECT, QUAD_COLUMNS, QUAD_KEY, as_term, graph_iri, graph_list, same, term_equals
from quadloom.operators.forms import instantiate
from quadloom.operators.membership import members_of
from quadloom.operators.solutions import Solutions


class UnknownGraph(ValueError):
    """The named graph does not exist."""


# -- set operations on quads -----------------------------------------------------


def distinct_quads(df: DataFrame) -> DataFrame:
    """One row per quad, with the smallest of its documents; ``membership.members_of`` has them all.

    Quads are compared by their hash first.  The rows are dealt out before repeats are merged:
    a task that reads holds none of them, however many quads its part of a file gives, and
    a hot quad is dealt to one task for each task that reads it.
    """
    rows = df.select(*QUAD_COLUMNS).withColumns({"hash__": F.xxhash64(*QUAD_KEY), "task__": F.spark_partition_id()})
    rows = _merged(rows.repartition("hash__", "task__"), ("task__",))
    return _merged(rows, ()).select(*QUAD_COLUMNS)


def hash_repeats(df: DataFrame, parts: int) -> DataFrame:
    """(hash__): the hashes of quad keys that several rows have; nothing but hashes is shuffled."""
    hashes = df.select(F.xxhash64(*QUAD_KEY).alias("hash__"))
    tasks = max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return hashes.repartition(tasks, "hash__").groupBy("hash__").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash__")


def merged_sets(df: DataFrame) -> DataFrame:
    """One row per quad of several sets: a quad has few rows, so each is sent to its task at once."""
    rows = df.select(*QUAD_COLUMNS).withColumn("hash__", F.xxhash64(*QUAD_KEY))
    return _merged(rows.repartition("hash__"), ()).select(*QUAD_COLUMNS)


def _merged(rows: DataFrame, more: tuple[str, ...]) -> DataFrame:
    rest = [F.min(c).alias(c) for c in QUAD_COLUMNS if c not in QUAD_KEY]
    return rows.groupBy("hash__", *more, *QUAD_KEY).agg(*rest)


def without(base: DataFrame, gone: DataFrame, key=QUAD_KEY) -> DataFrame:
    """Quads of ``base`` whose key is not in ``gone``.

    The keys are made distinct first, so a hot key weighs one row per map task.
    """
    gone = gone.select(*[F.col(c).alias(c) for c in key]).distinct()
    return base.join(gone, same(base, gone, key), "left_anti")


def only_new(base: DataFrame, new: DataFrame) -> DataFrame:
    """Quads of ``new`` that ``base`` does not hold, each once.

    The base is first cut down to the keys of ``new`` (a semi join: when the new
    quads are few they are broadcast and the base is not shuffled at all).
    """
    new = distinct_quads(new)
    keys = new.select(*[F.col(c).alias(c) for c in QUAD_KEY])
    slim = base.select(*[F.col(c).alias(c) for c in QUAD_KEY])
    held = slim.join(keys, same(slim, keys, QUAD_KEY), "left_semi")
    return new.join(held, same(new, held, QUAD_KEY), "left_anti")


# -- contexts ----------------------------------------------------------------------


def in_contexts(new: DataFrame, contexts: Iterable = ()) -> DataFrame:
    """Explicit contexts replace the statements' own graph; several make copies."""
    graphs = graph_list(contexts)
    if not graphs:
        return new.withColumn("g", F.coalesce("g", F.lit(V.DEFAULT_GRAPH))).select(*QUAD_COLUMNS)
    if len(graphs) == 1:
        return new.withColumn("g", F.lit(graphs[0])).select(*QUAD_COLUMNS)
    targets = F.explode(F.array(*[F.lit(g) for g in graphs]))
    return new.drop("g").withColumn("g", targets).select(*QUAD_COLUMNS)


def matches(s=None, p=None, o=None, contexts: Iterable = ()) -> Column:
    """Does a quad match the pattern?  None is a wildcard; no contexts means all graphs."""
    conds = []
    for slot, t in (("s", s), ("p", p)):
        if t is not None:
            conds.append(F.col(slot) == as_term(t).value)
    if o is not None:
        conds.append(term_equals({c: F.col(c) for c in OBJECT}, as_term(o)))
    graphs = graph_list(contexts)
    if graphs:
        conds.append(F.col("g").isin(graphs))
    # identity columns of the other kind are null: unknown counts as no match
    return F.coalesce(reduce(lambda a, b: a & b, conds, F.lit(True)), F.lit(False))


# -- the state ---------------------------------------------------------------------


@dataclass(frozen=True)
class Store:
    """A set of quads, additions to it, and the graphs registered without content.

    ``base`` is a set; ``added`` is a bag that may repeat quads.  Additions are
    merged when the state is read, once for any number of operations.
    """

    base: DataFrame
    added: DataFrame | None = None
    registered: DataFrame | None = None

    @property
    def quads(self) -> DataFrame:
        """The state as a set of quads."""
        base = self.base.select(*QUAD_COLUMNS)
        return base if self.added is None else base.union(only_new(base, self.added))

    @property
    def members(self) -> DataFrame:
        """Which documents give the quads: (quad key, doc_id).

        Quads of several documents come with further rows, one for each, among the additions.
        """
        base = self.base.select(*QUAD_COLUMNS)
        return members_of(base if self.added is None else base.union(self.added.select(*QUAD_COLUMNS)))

    def _each(self, change: Callable[[DataFrame], DataFrame]) -> Store:
        """Apply a removal to the base and to the additions."""
        added = None if self.added is None else change(self.added)
        return replace(self, base=change(self.base), added=added)

    # statements

    def add(self, new: DataFrame, contexts: Iterable = ()) -> Store:
        new = in_contexts(new, contexts)
        return replace(self, added=new if self.added is None else self.added.union(new))

    def insert_data(self, rows: Iterable[tuple], base: str | None = None) -> Store:
        """INSERT DATA: constant quads, the default graph unless one is given."""
        return self.add(statements(self.base.sparkSession, rows, base))

    def delete_data(self, rows: Iterable[tuple], base: str | None = None) -> Store:
        """DELETE DATA: exactly these quads; absent ones are ignored."""
        return self.remove_statements(statements(self.base.sparkSession, rows, base))

    def remove(self, s=None, p=None, o=None, contexts: Iterable = ()) -> Store:
        """Remove by pattern; no contexts removes from every graph."""
        return self._each(lambda df: df.where(~matches(s, p, o, contexts)))

    def remove_statements(
        self, gone: DataFrame, contexts: Iterable = (), any_graph: bool = False
    ) -> Store:
        """Remove given quads from their own graph, from ``contexts``, or from all graphs."""
        if any_graph and not graph_list(contexts):
            return self._each(lambda df: without(df, gone, QUAD_KEY[1:]))
        return self._each(lambda df: without(df, in_contexts(gone, contexts)))

    def modify(self, where: Solutions, delete=(), insert=(), graph=None, base: str | None = None) -> Store:
        """DELETE/INSERT WHERE: both templates use the old state; deletes go first."""
        store = self
        if delete:
            store = store.remove_statements(instantiate(where, delete, graph, base))
        if insert:
            store = store.add(instantiate(where, insert, graph, base))
        return store

    # graphs

    def graph_exists(self, graph) -> bool:
        here = F.col("g") == graph_iri(graph)
        places = [self.base, self.added, self.registered]
        return any(df is not None and not df.where(here).isEmpty() for df in places)

    def _need(self, graph) -> None:
        if not self.graph_exists(graph):
            raise UnknownGraph(f"unknown graph: {graph_iri(graph)}")

    def clear(self, contexts: Iterable | None = None) -> Store:
        """Clear everything, or the listed graphs; an empty list is the default graph."""
        if contexts is None:
            return replace(self, base=self.base.where(F.lit(False)), added=None)
        graphs = graph_list(contexts) or [V.DEFAULT_GRAPH]
        for g in graphs:
            if g != V.DEFAULT_GRAPH:
                self._need(g)
        return self._each(lambda df: df.where(~F.col("g").isin(graphs)))

    def create_graph(self, graph) -> Store:
        g = graph_iri(graph)
        if self.graph_exists(g):
            raise ValueError(f"graph exists: {g}")
        row = self.base.sparkSession.createDataFrame([(g,)], "g string")
        return replace(self, registered=row if self.registered is None else self.registered.union(row))

    def drop_graph(self, graph) -> Store:
        self._need(graph)
        other = F.col("g") != graph_iri(graph)
        registered = None if self.registered is None else self.registered.where(other)
        return replace(self._each(lambda df: df.where(other)), registered=registered)

    def add_graph(self, source, target) -> Store:
        """ADD source TO target."""
        self._need(source)
        store = self
        if graph_iri(source) != graph_iri(target):
            here = F.col("g") == graph_iri(source)
            for part in (self.base, self.added):
                if part is not None:
                    store = store.add(part.where(here), [target])
        return store

    def copy_graph(self, source, target) -> Store:
        """COPY source TO target: the target becomes the source's content."""
        a, b = graph_iri(source), graph_iri(target)
        self._need(a)
        if a == b:
            return self

        def copied(df: DataFrame) -> DataFrame:
            here = F.when(F.col("g") == a, F.array(F.lit(a), F.lit(b))).otherwise(F.array("g"))
            return df.where(F.col("g") != b).withColumn("g", F.explode(here)).select(*QUAD_COLUMNS)

        return self._each(copied)

    def move_graph(self, source, target) -> Store:
        """MOVE source TO target."""
        a, b = graph_iri(source), graph_iri(target)
        self._need(a)
        if a == b:
            return self
        moved = F.when(F.col("g") == a, F.lit(b)).otherwise(F.col("g"))
        return self._each(lambda df: df.where(F.col("g") != b).withColumn("g", moved).select(*QUAD_COLUMNS))

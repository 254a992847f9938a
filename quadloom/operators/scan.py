"""Statement scans and the graph catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.model import OBJECT, QUAD_COLUMNS, Term, as_term, default_graph_as_null, graph_list, term_equals
from quadloom.sources.stored import StoredQuads
from quadloom.sources.tables import TableQuads

Quads = DataFrame | TableQuads | StoredQuads


def frame(q: Quads) -> DataFrame:
    return q.df if isinstance(q, (TableQuads, StoredQuads)) else q


def match(
    q: Quads,
    s: Term | str | None = None,
    p: Term | str | None = None,
    o: Term | str | None = None,
    graphs: list[str] | None = None,
) -> tuple[DataFrame, bool]:
    """Quads with the given constants, and whether they come from one graph only."""
    s, p, o = (None if t is None else as_term(t) for t in (s, p, o))
    if isinstance(q, (TableQuads, StoredQuads)):
        if (s is not None and not s.is_iri) or (p is not None and not p.is_iri):
            return q.match()[0].where(F.lit(False)), True
        return q.match(s and s.value, p and p.value, o, graphs)
    df = q
    if graphs is not None:
        df = df.where(F.col("g").isin(graphs))
    if p is not None:
        df = df.where((F.col("p") == p.value) if p.is_iri else F.lit(False))
    if s is not None:
        df = df.where((F.col("s") == s.value) if s.is_iri else F.lit(False))
    if o is not None:
        df = df.where(term_equals({c: F.col(c) for c in OBJECT}, o))
    return df, graphs is not None and len(graphs) == 1


def scan(q: Quads, s=None, p=None, o=None, contexts=()) -> DataFrame:
    """Quads matching a pattern; None is a wildcard.

    ``contexts`` lists graphs (None = the default graph); no contexts means all.
    A statement in two graphs is two quads.  The default graph shows as null.
    """
    graphs = graph_list(contexts) or None
    df, _ = match(q, s, p, o, graphs)
    return df.withColumn("g", default_graph_as_null())


def has_statement(q: Quads, s=None, p=None, o=None, contexts=()) -> DataFrame:
    """One row ``(result boolean)``: does any quad match?"""
    return non_empty(match(q, s, p, o, graph_list(contexts) or None)[0])


def non_empty(df: DataFrame) -> DataFrame:
    """One row ``(result boolean)``.

    Looks at once, at a few partitions first and at more only while nothing is
    found; as a lazy plan every partition would have to be started.
    """
    found = not df.isEmpty()
    return df.sparkSession.range(1).select(F.lit(found).alias("result"))


def count_all(q: Quads) -> DataFrame:
    """One row ``(n long)``: all quads, each graph membership counted."""
    return _counted(q)


def count_in(q: Quads, contexts) -> DataFrame:
    """One row ``(n long)``: quads in the listed graphs; an empty list means the default graph."""
    graphs = graph_list(contexts) or [V.DEFAULT_GRAPH]
    if isinstance(q, TableQuads):
        return _counted(q.limited(graphs=graphs))
    return _counted(match(q, graphs=graphs)[0])


def _counted(q: Quads) -> DataFrame:
    if isinstance(q, TableQuads):
        return q.graph_counts().agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
    return frame(q).agg(F.count(F.lit(1)).alias("n"))


def is_empty(q: Quads) -> DataFrame:
    """One row ``(result boolean)``."""
    return non_empty(frame(q)).select((~F.col("result")).alias("result"))


def list_graphs(q: Quads, registered: DataFrame | None = None) -> DataFrame:
    """Distinct graph IRIs, the default graph included, plus registered empty ones."""
    graphs = (q.graph_counts() if isinstance(q, TableQuads) else frame(q)).select("g")
    if registered is not None:
        graphs = graphs.union(registered.select("g"))
    return graphs.distinct().orderBy("g")


def count_per_graph(q: Quads) -> DataFrame:
    """``(g, n)`` for every graph."""
    if isinstance(q, TableQuads):
        return q.graph_counts()
    return frame(q).groupBy("g").agg(F.count(F.lit(1)).alias("n"))


def export(q: Quads, s=None, p=None, o=None, contexts=()) -> DataFrame:
    """The quads an export writes, with the graph IRI kept (see ``sources.sinks``)."""
    return match(q, s, p, o, graph_list(contexts) or None)[0].select(*QUAD_COLUMNS)

"""Query forms and solution modifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.quad_columns import constant_object
from quadloom.model import TRIPLE_KEY, as_term, graph_iri
from quadloom.operators.patterns import _based, is_var
from quadloom.operators.scan import Quads, match, non_empty
from quadloom.operators.solutions import IDENTITY, VALUES, Solutions, aux
from quadloom.session import materialize, scratch_path

TRIPLE_COLUMNS = TRIPLE_KEY + ("o_num", "o_ts")



def ask(sol: Solutions | DataFrame) -> DataFrame:
    """ASK: one row ``(result boolean)``; stops at the first solution."""
    return non_empty(sol.df if isinstance(sol, Solutions) else sol)


def instantiate(sol: Solutions, templates: Iterable[tuple], graph=None, base: str | None = None) -> DataFrame:
    """Quads from templates ``(s, p, o[, g])``; rows with an unbound or illegal slot are skipped.

    Relative IRIs are resolved against ``base``.
    """
    parts = []
    for t in templates:
        s, p, o = t[:3]
        g = t[3] if len(t) > 3 else graph
        p = V.RDF_TYPE if p == "a" else p
        s, p, o, g = _based((s, p, o, g), base)
        df, keep = sol.df, F.lit(True)
        cols = {}
        for slot, x in (("g", g), ("s", s), ("p", p)):
            if is_var(x):
                name = x[1:]
                keep = keep & F.col(name).isNotNull()
                if name in sol.terms:
                    keep = keep & (F.col(aux(name, "kind")) == "iri")
                cols[slot] = F.col(name)
            else:
                if x is not None and not as_term(x).is_iri:
                    raise ValueError("only the object of a template can be a literal")
                cols[slot] = F.lit(graph_iri(x) if slot == "g" else as_term(x).value)
        if is_var(o):
            name = o[1:]
            keep = keep & F.col(name).isNotNull()
            whole = sol.as_terms([name])
            df = whole.df
            cols["o"] = F.col(name)
            for part in IDENTITY + VALUES:
                cols["o_" + part] = F.col(aux(name, part))
        else:
            cols.update(constant_object(as_term(o)))
        cols["doc_id"] = F.lit(None).cast("string")
        order = ("g",) + TRIPLE_COLUMNS + ("doc_id",)
        parts.append(df.where(keep).select(*[cols[c].alias(c) for c in order]))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def construct(sol: Solutions, templates: Iterable[tuple], base: str | None = None) -> DataFrame:
    """CONSTRUCT: the set of triples the templates give."""
    return instantiate(sol, templates, base=base).select(*TRIPLE_COLUMNS).dropDuplicates(list(TRIPLE_KEY))


def describe(q: Quads, *resources, base: str | None = None) -> DataFrame:
    """DESCRIBE <iri> ...: the triples with the resource as subject, over all graphs."""
    out = None
    for r in _based(resources, base):
        df, one_graph = match(q, s=r)
        df = df.select(*TRIPLE_COLUMNS)
        if not one_graph:
            df = df.dropDuplicates(list(TRIPLE_KEY))
        out = df if out is None else out.union(df)
    return out


# -- ordering and paging ---------------------------------------------------------


def order_keys(sol: Solutions, name: str, descending: bool = False) -> list[Column]:
    """ORDER BY ?x: unbound, then IRIs, then literals by number, time, then form."""
    cols = [F.col(name)]
    if name in sol.terms:
        kind, n, t = (F.col(aux(name, p)) for p in ("kind", "num", "ts"))
        rank = (
            F.when(kind.isNull(), 0)
            .when(kind == "iri", 1)
            .when(n.isNotNull(), 2)
            .when(t.isNotNull(), 3)
            .otherwise(4)
        )
        cols = [rank, n, t, F.col(name), F.col(aux(name, "dt")), F.col(aux(name, "lang"))]
    return [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in cols]


def order_by(sol: Solutions, *names: str) -> Solutions:
    """ORDER BY variables; ``"-x"`` sorts descending."""
    return sol._with(sol.df.orderBy(*sort_columns(sol, names)))


def sort_columns(sol: Solutions, names: Iterable[str]) -> list[Column]:
    return [c for n in names for c in order_keys(sol, n.lstrip("-"), n.startswith("-"))]


def limit(sol: Solutions, n: int) -> Solutions:
    """LIMIT (after ``order_by`` this is a distributed top-n)."""
    return sol._with(sol.df.limit(n))


def page(df: DataFrame, keys: list[Column], start: int, length: int, deep: bool = False) -> DataFrame:
    """Rows ``start`` (from 1) onwards in the order of ``keys``; length <= 0 means all.

    ``keys`` must be a total order for pages to fit together.  A page is a
    top-n, which holds the rows to be skipped.  For ``deep`` pages, and those
    without an end, the sorted rows are numbered once, and no task holds them.
    """
    if start < 1:
        raise ValueError("start counts from 1")
    ordered = df.orderBy(*keys)
    if start == 1 and length <= 0:
        return ordered
    if 0 < length and not deep:
        return ordered.offset(start - 1).limit(length)
    return _deep_page(df, keys, start, length)


def with_positions(df: DataFrame, keys: list[Column], name: str = "position") -> DataFrame:
    """The sorted rows with their place in the order, counted from 1.

    The sorted rows are stored once with their partition and row number; the
    partitions' sizes (one number each) turn these into places.
    """
    row = F.monotonically_increasing_id()
    numbered = materialize(
        df.orderBy(*keys).withColumns(
            {"part__": F.shiftright(row, 33), "row__": row.bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        scratch_path(df.sparkSession, "sorted"),
    )
    before, starts = 0, []
    for part, size in sorted((r["part__"], r["count"]) for r in numbered.groupBy("part__").count().collect()):
        starts.append((part, before))
        before += size
    ahead = df.sparkSession.createDataFrame(starts, "part__ long, ahead__ long")
    place = (F.col("ahead__") + F.col("row__") + 1).alias(name)
    # one row per partition of the sort
    return numbered.join(F.broadcast(ahead), "part__").select(*df.columns, place)


def _deep_page(df: DataFrame, keys: list[Column], start: int, length: int) -> DataFrame:
    placed = with_positions(df, keys, "place__").where(F.col("place__") >= start)
    if length > 0:
        placed = placed.where(F.col("place__") < start + length)
    return placed.orderBy("place__").drop("place__")


def slice_(df: DataFrame, keys: list[Column], offset: int = 0, limit: int | None = None) -> DataFrame:
    """OFFSET / LIMIT in the order of ``keys``."""
    if limit == 0:
        return df.limit(0)
    return page(df, keys, offset + 1, limit or 0)


def for_each(df: DataFrame, handler: Callable[[Iterator[Row]], None]) -> None:
    """Send the result to a handler, one call per non-empty partition, on the executors."""

    def run(rows: Iterator[Row]) -> None:
        first = next(rows, None)
        if first is None:
            return

        def all_rows():
            yield first
            yield from rows

        handler(all_rows())

    df.foreachPartition(run)

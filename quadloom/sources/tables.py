"""Relational tables as quads (application rows -> statements).

Every (table, predicate) pair is one branch: a plain ``select`` over the table
with a constant graph and predicate.  ``TableQuads`` is the union of the branches
without ever being written out.  A constant predicate or graph leaves only the
branches that can produce it, and a constant subject or object IRI is turned back
into a condition on the key column, so all of it reaches the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.model import OBJECT, QUAD_COLUMNS, Term, term_equals

# What an object position can hold besides IRIs with a known prefix.
LITERAL = "literal"


def sql_text(value: str | None) -> str:
    """A SQL string literal."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_key(text: str) -> bool:
    """Is this how a 64-bit integer key prints?"""
    digits = text.removeprefix("-")
    return digits.isascii() and digits.isdecimal() and str(int(text)) == text and abs(int(text)) < 2**63


@dataclass(frozen=True)
class Template:
    """An IRI made of a fixed prefix and one or more key expressions."""

    prefix: str
    keys: tuple[str, ...]
    separator: str = "-"
    integer: bool = True

    def sql(self) -> str:
        keys = f", {sql_text(self.separator)}, ".join(f"cast({k} as string)" for k in self.keys)
        return f"concat({sql_text(self.prefix)}, {keys})"

    def condition(self, value: str) -> str | None:
        """The rows whose IRI is ``value``, as a condition on the key columns."""
        if not value.startswith(self.prefix):
            return None
        rest = value[len(self.prefix):]
        parts = [rest] if len(self.keys) == 1 else rest.split(self.separator)
        if len(parts) != len(self.keys) or (self.integer and not all(_is_key(p) for p in parts)):
            return None
        if not self.integer:
            parts = [sql_text(p) for p in parts]
        return " and ".join(f"({k}) = {p}" for k, p in zip(self.keys, parts))


def template(prefix: str, *keys: str, separator: str = "-", integer: bool = True) -> Template:
    return Template(prefix, keys, separator, integer)


@dataclass(frozen=True)
class Value:
    """A literal taken from an expression over the table's columns."""

    expr: str
    dt: str = V.XSD_STRING

    def sql(self) -> str:
        if self.dt == V.XSD_DATETIME:
            return f"date_format({self.expr}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
        return f"cast({self.expr} as string)"

    def condition(self, term: Term) -> str | None:
        """Rows holding a string or integer constant, as a condition on the column."""
        if self.dt == V.XSD_STRING:
            return f"({self.expr}) = {sql_text(term.value)}"
        if self.dt in V.INTEGER_TYPES and _is_key(term.value):
            return f"({self.expr}) = {term.value}"
        return None


@dataclass(frozen=True)
class Branch:
    """One predicate of one table: all its quads share graph and predicate."""

    table: DataFrame
    graph: str
    subject: Template
    predicate: str
    object: Template | Value | Term
    where: str | None = None
    doc_id: str | None = None

    def object_shape(self) -> str:
        if isinstance(self.object, Template):
            return self.object.prefix
        if isinstance(self.object, Term) and self.object.is_iri:
            return self.object.value
        return LITERAL

    def sql(self) -> dict[str, str]:
        """The quad columns as SQL expressions."""
        obj, num, ts = self.object, "cast(null as double)", "cast(null as timestamp_ntz)"
        kind, dt, lang = "lit", None, None
        if isinstance(obj, Template):
            o, kind = obj.sql(), "iri"
        elif isinstance(obj, Value):
            o, dt = obj.sql(), obj.dt
            if dt in V.NUMERIC_TYPES:
                num = f"cast({obj.expr} as double)"
            elif dt in V.TIME_TYPES:
                ts = f"cast({obj.expr} as timestamp_ntz)"
        else:
            o, kind, dt, lang = sql_text(obj.value), obj.kind, obj.dt, obj.lang
            if dt in V.NUMERIC_TYPES:
                num = f"try_cast({o} as double)"
            elif dt in V.TIME_TYPES:
                ts = f"try_cast({o} as timestamp_ntz)"
        return {
            "g": sql_text(self.graph),
            "s": self.subject.sql(),
            "p": sql_text(self.predicate),
            "o": o,
            "o_kind": sql_text(kind),
            "o_dt": sql_text(dt),
            "o_lang": sql_text(lang),
            "o_num": num,
            "o_ts": ts,
            "doc_id": f"cast({self.doc_id or 'null'} as string)",
        }

    def rows(self, s: str | None = None, o: Term | None = None) -> DataFrame | None:
        """The branch's quads with a constant subject and/or object; None = no match."""
        conds = [self.where] if self.where else []
        late = None
        if s is not None:
            conds.append(self.subject.condition(s))
        if o is not None:
            if isinstance(self.object, Term):
                conds.append("true" if self.object == o else None)
            elif isinstance(self.object, Template):
                conds.append(self.object.condition(o.value) if o.is_iri else None)
            elif o.dt != self.object.dt or o.lang is not None:
                return None
            else:
                cond = self.object.condition(o)
                if cond is None:
                    late = o  # compare by lexical form
                else:
                    conds.append(cond)
        if None in conds:
            return None
        df = self.table
        for cond in conds:
            df = df.where(cond)
        df = df.selectExpr(*[f"{e} as {c}" for c, e in self.sql().items()])
        if not isinstance(self.object, Term):
            df = df.where("o is not null")
        if late is not None:
            df = df.where(term_equals({c: F.col(c) for c in OBJECT}, late))
        return df


@dataclass(frozen=True)
class TableQuads:
    """A set of quads defined by branches over tables.

    The tables must make each graph a set: unique keys, or distinct rows.
    """

    branches: tuple[Branch, ...]
    anchor: Branch | None = None  # gives an empty view its schema

    def match(
        self,
        s: str | None = None,
        p: str | None = None,
        o: Term | None = None,
        graphs: list[str] | None = None,
    ) -> tuple[DataFrame, bool]:
        """Matching quads, and whether all of them come from a single graph."""
        found, where = [], set()
        for b in self.limited(p, graphs).branches:
            rows = b.rows(s, o)
            if rows is not None:
                found.append(rows)
                where.add(b.graph)
        if not found:
            return (self.anchor or self.branches[0]).rows().where(F.lit(False)), True
        return reduce(DataFrame.union, found), len(where) == 1

    def limited(self, p: str | None = None, graphs: list[str] | None = None) -> TableQuads:
        """Only the branches with a given predicate and graphs."""
        kept = [
            b
            for b in self.branches
            if (p is None or b.predicate == p) and (graphs is None or b.graph in graphs)
        ]
        return TableQuads(tuple(kept), self.anchor or self.branches[0])

    @property
    def df(self) -> DataFrame:
        return self.match()[0]

    def graphs(self) -> list[str]:
        return sorted({b.graph for b in self.branches})

    def _by_table(self) -> list[list[Branch]]:
        groups: dict[int, list[Branch]] = {}
        for b in self.branches:
            groups.setdefault(id(b.table), []).append(b)
        return list(groups.values())

    def graph_counts(self) -> DataFrame:
        """``(g, n)`` for graphs with quads; one pass and one row of counters per table."""
        parts = []
        for group in self._by_table():
            counters = []
            for b in group:
                conds = ([b.where] if b.where else []) + [f"({b.sql()['o']}) is not null"]
                n = f"count_if({' and '.join(f'({c})' for c in conds)})"
                counters.append(f"named_struct('g', {sql_text(b.graph)}, 'n', {n})")
            row = group[0].table.selectExpr(f"array({', '.join(counters)}) as counters")
            parts.append(row.selectExpr("inline(counters)"))
        if not parts:
            return self.match()[0].groupBy("g").agg(F.count("s").alias("n"))
        return reduce(DataFrame.union, parts).groupBy("g").agg(F.sum("n").alias("n")).where("n > 0")

    def stacked(self) -> DataFrame:
        """All quads in one pass per table, for writing them out.

        Reads each table once instead of once per predicate; use ``match`` for
        queries, where the per-predicate branches prune better.
        """
        parts = []
        for group in self._by_table():
            rows = []
            for b in group:
                fields = ", ".join(f"'{c}', {e}" for c, e in b.sql().items())
                quad = f"named_struct({fields})"
                rows.append(f"case when {b.where} then {quad} end" if b.where else quad)
            quads = f"filter(array({', '.join(rows)}), q -> q.o is not null)"
            parts.append(group[0].table.selectExpr(f"inline({quads})").select(*QUAD_COLUMNS))
        return reduce(DataFrame.union, parts)


def _compatible(a: str, b: str) -> bool:
    if LITERAL in (a, b):
        return a == b
    return a.startswith(b) or b.startswith(a)


def narrow_together(views: list[TableQuads], slots: list[tuple[str | None, str | None]]) -> list[TableQuads]:
    """Drop branches that cannot join: a shared variable needs IRIs of one shape.

    ``slots`` names the variables in the subject and object position of each
    view.  ``?c inNation ?n . ?n name ?x`` then never reads the names of customers.
    """
    while True:
        shapes: dict[str, list[set[str]]] = {}
        for view, (s, o) in zip(views, slots):
            if s is not None:
                shapes.setdefault(s, []).append({b.subject.prefix for b in view.branches})
            if o is not None:
                shapes.setdefault(o, []).append({b.object_shape() for b in view.branches})

        def fits(name: str | None, shape: str) -> bool:
            return name is None or all(any(_compatible(shape, x) for x in xs) for xs in shapes[name])

        kept = [
            replace(
                view,
                branches=tuple(
                    b for b in view.branches if fits(s, b.subject.prefix) and fits(o, b.object_shape())
                ),
            )
            for view, (s, o) in zip(views, slots)
        ]
        if [len(v.branches) for v in kept] == [len(v.branches) for v in views]:
            return kept
        views = kept

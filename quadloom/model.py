"""The quad table: its columns, its keys, and constant RDF terms.

A quad is one flat row, so that filters and column pruning reach Parquet and
joins need no struct rebuilding:

    g, s, p      graph, subject and predicate IRI
    o            object IRI or the lexical form of a literal
    o_kind       'iri' | 'lit'
    o_dt, o_lang datatype IRI or language tag of a literal (one of them is set)
    o_num, o_ts  typed value when the datatype is numeric / a date or dateTime
    doc_id       document the quad was extracted from, if any

Term identity is (o, o_kind, o_dt, o_lang), compared null-safe.  ``o_num`` and
``o_ts`` are functions of the term and never take part in identity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom import vocab as V

OBJECT = ("o", "o_kind", "o_dt", "o_lang")
TRIPLE_KEY = ("s", "p") + OBJECT
QUAD_KEY = ("g",) + TRIPLE_KEY
QUAD_COLUMNS = QUAD_KEY + ("o_num", "o_ts", "doc_id")
QUAD_SCHEMA = (
    "g string, s string, p string, o string, o_kind string, o_dt string, "
    "o_lang string, o_num double, o_ts timestamp_ntz, doc_id string"
)


@dataclass(frozen=True)
class Term:
    """A constant IRI or literal."""

    value: str
    kind: str = "iri"
    dt: str | None = None
    lang: str | None = None

    @property
    def is_iri(self) -> bool:
        return self.kind == "iri"


def iri(value: str) -> Term:
    """An IRI; ``_:id`` is skolemized, so a blank-node id always gives one IRI."""
    if value is None:
        raise ValueError("a term must not be null")
    if value.startswith("_:"):
        value = V.BLANK_PREFIX + value[2:]
    return Term(value)


_ABSOLUTE = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")
_BASE = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*:)(//[^/?#]*)?([^?#]*)(\?[^#]*)?")


def with_base(value, base: str | None):
    """A constant IRI resolved against ``base``; variables, literals, paths and absolute IRIs stay as they are."""
    if base is None or not isinstance(value, (str, Term)) or (isinstance(value, str) and value.startswith("?")):
        return value
    term = as_term(value)
    if not term.is_iri or _ABSOLUTE.match(term.value):
        return value
    return Term(_resolved(term.value, base))


def _resolved(ref: str, base: str) -> str:
    """RFC 3986 section 5.2 for one reference, as ``terms.resolve_iri`` for a column."""
    m = _BASE.match(base)
    if m is None:
        raise ValueError(f"base IRI is not absolute: {base!r}")
    scheme, authority, path, query = (part or "" for part in m.groups())
    ref_path = re.match("[^?#]*", ref)[0]
    rest = ref[len(ref_path):]
    if ref.startswith("//"):
        return scheme + ref
    if not ref_path:
        return scheme + authority + path + (rest if rest.startswith("?") else query + rest)
    if not ref_path.startswith("/"):
        folder = path[: path.rfind("/") + 1] or ("/" if authority else "")
        ref_path = folder + ref_path
    return scheme + authority + _without_dots(ref_path) + rest


def _without_dots(path: str) -> str:
    if "/." not in path:
        return path
    kept: list[str] = []
    segments = path.split("/")
    for segment in segments:
        if segment == "..":
            del kept[max(1, len(kept) - 1):]
        elif segment != ".":
            kept.append(segment)
    out = "/".join(kept)
    return out + "/" if segments[-1] in (".", "..") and not out.endswith("/") else out


def lit(value, dt: str | None = None, lang: str | None = None) -> Term:
    """A literal from a Python value; a plain string is an ``xsd:string``."""
    if value is None:
        raise ValueError("a term must not be null")
    if lang is not None:
        return Term(str(value), "lit", None, lang.lower())
    if dt is None:
        if isinstance(value, bool):
            dt = V.XSD_BOOLEAN
        elif isinstance(value, int):
            dt = V.XSD_INTEGER
        elif isinstance(value, float):
            dt = V.XSD_DOUBLE
        else:
            dt = V.XSD_STRING
    if isinstance(value, bool):
        value = str(value).lower()
    return Term(str(value), "lit", dt)


def as_term(value) -> Term:
    """Plain strings given where a term is expected are IRIs."""
    return value if isinstance(value, Term) else iri(value)


def graph_iri(context) -> str:
    """A context argument as a graph IRI; ``None`` is the default graph."""
    return V.DEFAULT_GRAPH if context is None else as_term(context).value


def graph_list(contexts) -> list[str]:
    """Check a contexts argument: the list itself must not be null, its items may."""
    if contexts is None:
        raise ValueError("contexts must be a list; use [None] for the default graph")
    if isinstance(contexts, (str, Term)):
        contexts = [contexts]
    return sorted({graph_iri(c) for c in contexts})


def default_graph_as_null(g: Column | str = "g") -> Column:
    """The API view of a graph column: the default graph shows as null."""
    return F.nullif(F.col(g) if isinstance(g, str) else g, F.lit(V.DEFAULT_GRAPH))


def term_equals(prefix_cols: dict[str, Column], term: Term) -> Column:
    """Term identity between four columns and a constant."""
    cond = (prefix_cols["o"] == F.lit(term.value)) & (
        prefix_cols["o_kind"] == F.lit(term.kind)
    )
    if term.kind == "lit":
        if term.lang is not None:
            cond = cond & (prefix_cols["o_lang"] == F.lit(term.lang))
        else:
            cond = cond & (prefix_cols["o_dt"] == F.lit(term.dt))
    return cond


def empty_quads(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], QUAD_SCHEMA)


def same(left: DataFrame, right: DataFrame, cols) -> Column:
    """Null-safe equality of ``cols`` between two frames.

    Only datatype and language may be null, so the other columns join plainly.
    """
    cond = None
    for c in cols:
        eq = (
            left[c].eqNullSafe(right[c])
            if c in ("o_dt", "o_lang")
            else left[c] == right[c]
        )
        cond = eq if cond is None else cond & eq
    return cond

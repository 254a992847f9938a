"""Readers for RDF files and for documents with embedded triples.

All of them parse with built-in expressions.  N-Triples and N-Quads are line
formats and split freely over tasks; they are the formats for bulk data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions import terms as T
from quadloom.functions.quad_columns import normalize
from quadloom.model import QUAD_COLUMNS
from quadloom.operators.updates import in_contexts
from quadloom.sources.json_subjects import subjects

# Format names; quad formats carry their own graph.
TRIPLE_FORMATS = ("ntriples", "rdfjson")
QUAD_FORMATS = ("nquads",)

# One statement of the N-Quads grammar (an N-Triples one lacks the graph).
IRI_FORM = r'<[^<>"{}|^`\x00-\x20]*>'
BLANK_FORM = r"_:[^\s<>\"]+"
LITERAL_FORM = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\^\^' + IRI_FORM + r"|@[A-Za-z0-9_-]+)?"
STATEMENT_FORM = (
    rf"^\s*({IRI_FORM}|{BLANK_FORM})\s*({IRI_FORM})\s*({IRI_FORM}|{BLANK_FORM}|{LITERAL_FORM})"
    rf"\s*({IRI_FORM}|{BLANK_FORM})?\s*\.\s*(?:#.*)?$"
)
SKIP_FORM = r"^\s*(?:#.*)?$"
SEP = "\u0001"

FAILFAST, DROP = "FAILFAST", "DROPMALFORMED"


class UnsupportedFormat(ValueError):
    """The format is not one this library reads."""


def check_format(fmt: str) -> str:
    fmt = fmt.lower().replace("-", "")
    if fmt not in TRIPLE_FORMATS + QUAD_FORMATS:
        raise UnsupportedFormat(f"cannot read {fmt!r}; supported: {TRIPLE_FORMATS + QUAD_FORMATS}")
    return fmt


def load(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    base: str | None = None,
    contexts: Iterable = (),
    mode: str = FAILFAST,
    multiline: bool = True,
) -> DataFrame:
    """Read files into quads.

    Triples go to the given contexts (several make copies), or the default graph;
    for quad formats the contexts are ignored.  ``mode`` says what malformed lines
    and literals do: fail the job, or be left out (see ``malformed``).  RDF/JSON is one
    object per file, read in byte ranges and cut at its subjects, or with
    ``multiline=False`` one object per line.
    """
    fmt = check_format(fmt)
    raw = _raw(spark, path, fmt, multiline)
    good = F.col("problem").isNull()
    if mode == FAILFAST:
        message = F.concat(F.col("problem"), F.lit(": "), F.col("line"))
        raw = raw.where(F.when(good, True).otherwise(F.raise_error(message).cast("boolean")))
    elif mode == DROP:
        raw = raw.where(good)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    quads = normalize(raw, base=base, scope=F.col("scope"))
    return quads.select(*QUAD_COLUMNS) if fmt in QUAD_FORMATS else in_contexts(quads, contexts)


def malformed(spark: SparkSession, path: str | list[str], fmt: str, multiline: bool = True) -> DataFrame:
    """The quarantine: ``(problem, line)`` of what ``load`` leaves out."""
    raw = _raw(spark, path, check_format(fmt), multiline)
    return raw.where(F.col("problem").isNotNull()).select("problem", "line")


def _raw(spark: SparkSession, path, fmt: str, multiline: bool) -> DataFrame:
    # blank-node labels are local to their file
    scope = F.sha1(F.input_file_name()).alias("scope")
    if fmt == "rdfjson":
        if multiline:
            lines = subjects(spark, path).select("line", F.sha1("file").alias("scope"))
        else:
            lines = spark.read.text(path).select(F.col("value").alias("line"), scope)
        return parse_rdfjson(lines)
    lines = spark.read.text(path).select(F.col("value").alias("line"), scope)
    return parse_lines(lines, with_graph=fmt in QUAD_FORMATS)


def parse_lines(lines: DataFrame, with_graph: bool = True) -> DataFrame:
    """N-Triples / N-Quads lines (column ``line``) as raw terms with a ``problem`` column."""
    lines = lines.where(~F.col("line").rlike(SKIP_FORM))
    # one pass of the expression per line; the object comes last as it may hold anything
    fields = F.split(
        F.regexp_replace("line", STATEMENT_FORM, f"$1{SEP}$2{SEP}$4{SEP}$3"), SEP, 4
    )
    s, p, g, o = (F.get("f", F.lit(i)) for i in range(4))
    df = computed_once(lines, f=fields)
    df = computed_once(
        df,
        ok=F.size("f") == 4,
        g=_node(g),
        s=_node(s),
        p=_node(p),
        token=o,
        suffix=F.when(o.startswith('"'), F.substring_index(o, '"', -1)),
    ).drop("f")
    token, suffix = F.col("token"), F.col("suffix")
    is_lit = suffix.isNotNull()
    form = token.substr(F.lit(2), F.length(token) - F.length(suffix) - 2)
    df = computed_once(
        df,
        o=F.when(is_lit, T.unescape(form)).otherwise(_node(token)),
        o_kind=F.when(is_lit, F.lit("lit")).otherwise(F.lit("iri")),
        o_dt=F.when(suffix.startswith("^^"), _node(suffix.substr(F.lit(3), F.length(suffix)))),
        o_lang=F.when(suffix.startswith("@"), suffix.substr(F.lit(2), F.length(suffix))),
    ).drop("token", "suffix")
    problem = _literal_problem()
    if not with_graph:
        problem = F.when(F.col("g").isNotNull(), F.lit("unexpected graph")).otherwise(problem)
    problem = F.when(~F.col("ok"), F.lit("malformed line")).otherwise(problem)
    return computed_once(df, problem=problem).drop("ok")


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters refer to as values.

    A filter over plain computed columns would be moved below them and repeat
    their expressions, here costly ones over whole texts, once per use.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*df.columns, F.inline(F.array(row)))


def _node(token: Column) -> Column:
    """``<iri>`` or ``_:label`` as its string; an empty token is null."""
    inner = T.unescape(token.substr(F.lit(2), F.length(token) - 2))
    return F.when(token.startswith("<"), inner).when(token != "", token)


def _literal_problem() -> Column:
    bad = (F.col("o_kind") == "lit") & ~T.is_valid_literal("o", "o_dt", "o_lang")
    return F.when(bad, F.lit("malformed literal"))


# subject -> predicate -> objects
RDFJSON_SCHEMA = (
    "map<string, map<string, array<struct<value: string, type: string, lang: string, datatype: string>>>>"
)


def parse_rdfjson(docs: DataFrame) -> DataFrame:
    """RDF/JSON documents (column ``line``) as raw terms with a ``problem`` column."""
    parsed = docs.withColumn("j", F.from_json("line", RDFJSON_SCHEMA))
    by_subject = parsed.select(
        "line", "scope", F.col("j").isNull().alias("bad"), F.explode_outer("j").alias("s", "ps")
    )
    # a subject without predicates, or a predicate without values, says nothing
    by_subject = by_subject.where(F.coalesce(F.size("ps") != 0, F.lit(True)))
    by_predicate = by_subject.select("line", "scope", "bad", "s", F.explode_outer("ps").alias("p", "os"))
    by_predicate = by_predicate.where(F.coalesce(F.size("os") != 0, F.lit(True)))
    rows = by_predicate.select("line", "scope", "bad", "s", "p", F.inline_outer("os"))
    df = rows.select(
        "line",
        "scope",
        "bad",
        F.lit(None).cast("string").alias("g"),
        "s",
        "p",
        F.col("value").alias("o"),
        F.when(F.col("type") == "literal", F.lit("lit")).otherwise(F.lit("iri")).alias("o_kind"),
        F.col("datatype").alias("o_dt"),
        F.nullif("lang", F.lit("")).alias("o_lang"),
    ).where(F.col("bad") | F.col("s").isNotNull())
    missing = F.col("s").isNull() | F.col("p").isNull() | F.col("o").isNull()
    problem = F.when(F.col("bad") | missing, F.lit("malformed document")).otherwise(_literal_problem())
    return computed_once(df, problem=problem).drop("bad")


# -- documents with embedded triples ------------------------------------------------


def embedded_schema(element: str = "sem") -> str:
    """Shape of the triples element; other elements of a document are ignored."""
    e = element
    obj = "struct<_VALUE: string, _datatype: string, `_xml:lang`: string>"
    one = f"struct<`{e}:subject`: string, `{e}:predicate`: string, `{e}:object`: {obj}>"
    return f"struct<`{e}:triples`: array<struct<`{e}:triple`: array<{one}>>>>"


def extract_embedded(
    documents: DataFrame,
    xml: str = "xml",
    doc_id: str = "doc_id",
    graph: Column | None = None,
    element: str = "sem",
    base: str | None = None,
) -> DataFrame:
    """Triples embedded in XML documents, with ``doc_id`` saying where they came from."""
    e = element
    docs = documents.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        (F.lit(V.DEFAULT_GRAPH) if graph is None else graph).alias("g"),
        F.from_xml(xml, embedded_schema(e)).alias("x"),
    )
    blocks = docs.select("doc_id", "g", F.explode(F.col(f"x.`{e}:triples`")).alias("b"))
    triples = blocks.select("doc_id", "g", F.explode(F.col(f"b.`{e}:triple`")).alias("t"))
    obj = f"t.`{e}:object`"
    dt, lang = F.col(f"{obj}._datatype"), F.col(f"{obj}.`_xml:lang`")
    raw = triples.select(
        "g",
        F.trim(F.col(f"t.`{e}:subject`")).alias("s"),
        F.trim(F.col(f"t.`{e}:predicate`")).alias("p"),
        F.col(f"{obj}._VALUE").alias("o"),
        # an object without datatype or language is an IRI
        F.when(dt.isNull() & lang.isNull(), F.lit("iri")).otherwise(F.lit("lit")).alias("o_kind"),
        dt.alias("o_dt"),
        lang.alias("o_lang"),
        "doc_id",
    )
    return normalize(raw, base=base)

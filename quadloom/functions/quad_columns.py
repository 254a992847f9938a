"""Columns of a quad row, and normalisation of raw rows into quads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions import terms as T
from quadloom.model import QUAD_COLUMNS, QUAD_SCHEMA, Term, as_term, graph_iri, with_base


def constant_object(term: Term) -> dict[str, Column]:
    """The object columns of a constant term."""
    dt = F.lit(term.dt).cast("string")
    return {
        "o": F.lit(term.value),
        "o_kind": F.lit(term.kind),
        "o_dt": dt,
        "o_lang": F.lit(term.lang).cast("string"),
        "o_num": T.numeric_value(F.lit(term.value), dt),
        "o_ts": T.time_value(F.lit(term.value), dt),
    }


def normalize(raw: DataFrame, base: str | None = None, scope: Column | None = None) -> DataFrame:
    """Raw (g, s, p, o, o_kind, o_dt, o_lang[, doc_id]) rows as quads.

    Resolves relative IRIs, skolemizes blank nodes, lower-cases language tags,
    types plain literals as xsd:string and derives the typed value columns.
    Rows with a null term make the job fail.
    """

    def node(c: Column) -> Column:
        if base is not None:
            c = T.resolve_iri(c, base)
        return T.skolemize(c, scope)

    is_iri = F.col("o_kind") == "iri"
    df = raw.select(
        F.coalesce(node(F.col("g")), F.lit(V.DEFAULT_GRAPH)).alias("g"),
        node(required("s")).alias("s"),
        node(required("p")).alias("p"),
        F.when(is_iri, node(required("o"))).otherwise(required("o")).alias("o"),
        "o_kind",
        F.when(
            ~is_iri & F.col("o_lang").isNull(), F.coalesce("o_dt", F.lit(V.XSD_STRING))
        ).alias("o_dt"),
        F.when(~is_iri, F.lower("o_lang")).alias("o_lang"),
        *(["doc_id"] if "doc_id" in raw.columns else [F.lit(None).cast("string").alias("doc_id")]),
    )
    return with_values(df)


def with_values(df: DataFrame, *more: str) -> DataFrame:
    """Add ``o_num`` / ``o_ts`` from the lexical form; of other columns only ``more`` are kept."""
    return df.withColumns(
        {"o_num": T.numeric_value("o", "o_dt"), "o_ts": T.time_value("o", "o_dt")}
    ).select(*QUAD_COLUMNS, *more)


def required(name: str) -> Column:
    """A term column that makes the job fail when it is null."""
    return F.when(F.col(name).isNull(), F.raise_error(F.lit(f"null term in column {name}"))).otherwise(
        F.col(name)
    )


def statements(spark: SparkSession, rows: Iterable[tuple], base: str | None = None) -> DataFrame:
    """A few constant statements ``(s, p, o[, g])`` as quads; relative IRIs are resolved against ``base``."""
    data = []
    for row in rows:
        s, p, o, *g = (with_base(t, base) for t in row)
        if s is None or p is None or o is None:
            raise ValueError("subject, predicate and object must not be null")
        s, p, o = as_term(s), as_term(p), as_term(o)
        data.append((graph_iri(g[0] if g else None), s.value, p.value, o.value, o.kind, o.dt, o.lang))
    raw_schema = ", ".join(QUAD_SCHEMA.split(", ")[:7])
    return with_values(
        spark.createDataFrame(data, raw_schema).withColumn("doc_id", F.lit(None).cast("string"))
    )

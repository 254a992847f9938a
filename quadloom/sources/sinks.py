"""Writers for quads and for bindings.  All of them write one file per task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.terms import escape_iri, to_ntriples
from quadloom.operators.solutions import Solutions, aux


def nquads_lines(quads: DataFrame) -> DataFrame:
    """One N-Quads line per quad (column ``value``); no graph for the default graph."""
    obj = to_ntriples("o", "o_kind", "o_dt", "o_lang")
    graph = F.when(F.col("g") != V.DEFAULT_GRAPH, F.concat(F.lit("<"), escape_iri("g"), F.lit(">")))
    line = F.concat_ws(
        " ",
        F.concat(F.lit("<"), escape_iri("s"), F.lit(">")),
        F.concat(F.lit("<"), escape_iri("p"), F.lit(">")),
        obj,
        graph,
        F.lit("."),
    )
    return quads.select(line.alias("value"))


def write_nquads(quads: DataFrame, path: str, compression: str = "none") -> None:
    """Uncompressed text by default: it can be read back in splits."""
    nquads_lines(quads).write.mode("overwrite").option("compression", compression).text(path)


def write_parquet(quads: DataFrame, path: str, partition_by: Iterable[str] = ("p",)) -> None:
    """The native form, by default one folder per predicate."""
    quads.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def _binding(sol: Solutions, name: str) -> Column:
    value = F.col(name).alias("value")
    if name not in sol.terms:
        return F.when(F.col(name).isNotNull(), F.struct(F.lit("uri").alias("type"), value))
    kind, dt, lang = (F.col(aux(name, p)) for p in ("kind", "dt", "lang"))
    return F.when(
        F.col(name).isNotNull(),
        F.struct(
            F.when(kind == "iri", F.lit("uri")).otherwise(F.lit("literal")).alias("type"),
            value,
            F.when(dt != V.XSD_STRING, dt).alias("datatype"),
            lang.alias("xml:lang"),
        ),
    )


def json_bindings(sol: Solutions, names: Iterable[str] | None = None) -> DataFrame:
    """One SPARQL-results JSON binding object per solution; unbound variables are left out."""
    names = list(names or sol.vars)
    row = F.struct(*[_binding(sol, n).alias(n) for n in names])
    return sol.df.select(F.to_json(row).alias("value"))


def write_json_bindings(sol: Solutions, path: str, names: Iterable[str] | None = None) -> None:
    """SPARQL-results JSON, one binding per line."""
    json_bindings(sol, names).write.mode("overwrite").text(path)


def write_csv(sol: Solutions, path: str, names: Iterable[str] | None = None) -> None:
    """SPARQL-results CSV: plain values, with a header."""
    df = sol.df.select(*(names or sol.vars))
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def tsv_rows(sol: Solutions, names: Iterable[str] | None = None) -> DataFrame:
    """SPARQL-results TSV rows: terms in N-Triples syntax, empty when unbound."""
    names = list(names or sol.vars)
    full = sol.as_terms(names)
    cols = [
        F.coalesce(to_ntriples(n, aux(n, "kind"), aux(n, "dt"), aux(n, "lang")), F.lit("")) for n in names
    ]
    return full.df.select(F.concat_ws("\t", *cols).alias("value"))


def write_tsv(sol: Solutions, path: str, names: Iterable[str] | None = None) -> None:
    tsv_rows(sol, names).write.mode("overwrite").text(path)


def xml_bindings(sol: Solutions, names: Iterable[str] | None = None) -> DataFrame:
    """One SPARQL-results XML ``<result>`` per solution."""
    names = list(names or sol.vars)
    bindings = []
    full = sol.as_terms(names)
    for n in names:
        kind, dt, lang = (F.col(aux(n, p)) for p in ("kind", "dt", "lang"))
        attribute = (
            F.when(lang.isNotNull(), F.concat(F.lit(' xml:lang="'), lang, F.lit('"')))
            .when(dt != V.XSD_STRING, F.concat(F.lit(' datatype="'), _xml_text(dt), F.lit('"')))
            .otherwise(F.lit(""))
        )
        text = _xml_text(F.col(n))
        term = F.when(kind == "iri", F.concat(F.lit("<uri>"), text, F.lit("</uri>"))).otherwise(
            F.concat(F.lit("<literal"), attribute, F.lit(">"), text, F.lit("</literal>"))
        )
        bound = F.concat(F.lit(f'<binding name="{n}">'), term, F.lit("</binding>"))
        bindings.append(F.when(F.col(n).isNotNull(), bound).otherwise(F.lit("")))
    return full.df.select(F.concat(F.lit("<result>"), *bindings, F.lit("</result>")).alias("value"))


def write_xml(sol: Solutions, path: str, names: Iterable[str] | None = None) -> None:
    """SPARQL-results XML, one ``<result>`` element per line."""
    xml_bindings(sol, names).write.mode("overwrite").text(path)


def _xml_text(c: Column) -> Column:
    # XML character escapes, ampersand first.
    for raw, escaped in (
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"),
    ):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c

"""Registered queries: a name, a Spark query and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(tune(spark), sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        if f.__name__ in QUERIES:
            raise ValueError(f"query {f.__name__} is registered twice")
        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql.strip()
        return f

    return register


def plain(df: DataFrame) -> DataFrame:
    """Quads in a form two engines print alike: typed values instead of number and time texts."""
    typed = F.col("o_num").isNotNull() | F.col("o_ts").isNotNull()
    return df.select(
        *(["g"] if "g" in df.columns else []),
        "s",
        "p",
        F.when(~typed, F.col("o")).alias("o_text"),
        "o_kind",
        "o_num",
        F.date_format("o_ts", "yyyy-MM-dd HH:mm:ss").alias("o_time"),
    )


def time_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# The same mapping as ``plans.mapping`` as SQL, in the form of ``plain``.
_TEXT = "'lit' as o_kind, null::double as o_num, null::varchar as o_time"
_IRI = "'iri' as o_kind, null::double as o_num, null::varchar as o_time"


def _num(expr: str) -> str:
    return f"null::varchar as o_text, 'lit' as o_kind, ({expr})::double as o_num, null::varchar as o_time"


def _customers(graph: str, where: str) -> list[str]:
    s = f"'{graph}' as g, 'urn:customer:' || c_custkey as s"
    rich = "c_acctbal > 5000"
    return [
        f"select {s}, 'urn:p:name' as p, c_name as o_text, {_TEXT} from customer where {where}",
        f"select {s}, 'urn:p:inNation', 'urn:nation:' || c_nationkey, {_IRI} from customer where {where}",
        f"select {s}, 'urn:p:acctbal', {_num('c_acctbal')} from customer where {where}",
        f"select {s}, 'urn:p:segment', c_mktsegment, {_TEXT} from customer where {where}",
        f"select {s}, 'urn:p:vip', 'true', {_TEXT} from customer where {where} and {rich}",
    ]


_D = "'urn:x-default-graph'"
_RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"

PARTS_SQL = {
    "default": [
        f"select {_D} as g, 'urn:region:' || r_regionkey as s, 'urn:p:name' as p, r_name as o_text, {_TEXT} from region",
        f"select {_D}, 'urn:nation:' || n_nationkey, 'urn:p:name', n_name, {_TEXT} from nation",
        f"select {_D}, 'urn:nation:' || n_nationkey, 'urn:p:inRegion', 'urn:region:' || n_regionkey, {_IRI} from nation",
        f"select {_D}, 'urn:nation:' || n_nationkey, 'urn:p:next', 'urn:nation:' || ((n_nationkey + 1) % 25), {_IRI} from nation",
    ],
    "customer": _customers("urn:g:customer", "true"),
    "vip": _customers("urn:g:vip", "c_acctbal > 5000"),
    "supplier": [
        f"select 'urn:g:supplier' as g, 'urn:supplier:' || s_suppkey as s, 'urn:p:name' as p, s_name as o_text, {_TEXT} from supplier",
        f"select 'urn:g:supplier', 'urn:supplier:' || s_suppkey, 'urn:p:inNation', 'urn:nation:' || s_nationkey, {_IRI} from supplier",
        f"select 'urn:g:supplier', 'urn:supplier:' || s_suppkey, 'urn:p:acctbal', {_num('s_acctbal')} from supplier",
    ],
    "part": [
        f"select 'urn:g:part' as g, 'urn:part:' || p_partkey as s, 'urn:p:name' as p, p_name as o_text, {_TEXT} from part",
        f"select 'urn:g:part', 'urn:part:' || p_partkey, 'urn:p:brand', p_brand, {_TEXT} from part",
        f"select 'urn:g:part', 'urn:part:' || p_partkey, 'urn:p:size', {_num('p_size')} from part",
        f"select 'urn:g:part', 'urn:part:' || p_partkey, 'urn:p:price', {_num('p_retailprice')} from part",
        f"select 'urn:g:part', 'urn:part:' || p_partkey, '{_RDF_TYPE}', 'urn:class:' || p_type, {_IRI} from part",
    ],
    "orders": [
        f"select 'urn:g:orders' as g, 'urn:order:' || o_orderkey as s, 'urn:p:placedBy' as p, 'urn:customer:' || o_custkey as o_text, {_IRI} from orders",
        f"select 'urn:g:orders', 'urn:order:' || o_orderkey, 'urn:p:status', o_orderstatus, {_TEXT} from orders",
        f"select 'urn:g:orders', 'urn:order:' || o_orderkey, 'urn:p:priority', o_orderpriority, {_TEXT} from orders",
        f"select 'urn:g:orders', 'urn:order:' || o_orderkey, 'urn:p:total', {_num('o_totalprice')} from orders",
        "select 'urn:g:orders', 'urn:order:' || o_orderkey, 'urn:p:date', null::varchar, 'lit', null::double, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') from orders",
    ],
    "lineitem": [
        f"select distinct 'urn:g:lineitem' as g, 'urn:order:' || l_orderkey as s, 'urn:p:hasPart' as p, 'urn:part:' || l_partkey as o_text, {_IRI} from lineitem",
    ],
    "conv": [
        f"select 'urn:g:conv' as g, 'urn:turn:' || conv_id || '-' || (turn - 1) as s, 'urn:p:next' as p, 'urn:turn:' || conv_id || '-' || turn as o_text, {_IRI} from conversations where turn > 0",
        f"select 'urn:g:conv', 'urn:turn:' || conv_id || '-' || turn, 'urn:p:role', role, {_TEXT} from conversations",
    ],
    "documents": [
        f"select 'urn:g:documents' as g, 'urn:doc:' || doc_id as s, 'urn:p:lang' as p, lang as o_text, {_TEXT} from documents where lang is not null",
        f"select 'urn:g:documents', 'urn:doc:' || doc_id, 'urn:p:source', source, {_TEXT} from documents where source is not null",
        f"select 'urn:g:documents', 'urn:doc:' || doc_id, 'urn:p:chars', {_num('n_chars')} from documents where n_chars is not null",
    ],
}


def quads_sql(*graphs: str) -> str:
    """``with q as (...)``: the quads of the named graphs, or of all of them."""
    parts = [p for g in (graphs or PARTS_SQL) for p in PARTS_SQL[g]]
    return "with q(g, s, p, o_text, o_kind, o_num, o_time) as (" + "\nunion all\n".join(parts) + ")\n"

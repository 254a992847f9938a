"""Registered queries: statement scans and the graph catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.operators import scan as S
from quadloom.plans.mapping import G, P, quads
from quadloom.plans.registry import plain, quads_sql, query

_SHOW = "nullif(g, 'urn:x-default-graph') as g, s, p, o_text, o_kind, o_num, o_time"


@query(quads_sql() + f"select {_SHOW} from q")
def scan_all_wildcards(spark, sf_dir):
    return plain(S.scan(quads(spark, sf_dir)))


@query(quads_sql() + f"select {_SHOW} from q where p = 'urn:p:name'")
def scan_by_predicate(spark, sf_dir):
    return plain(S.scan(quads(spark, sf_dir), p=P + "name"))


@query(quads_sql() + f"select {_SHOW} from q where s = 'urn:customer:7'")
def scan_by_subject(spark, sf_dir):
    return plain(S.scan(quads(spark, sf_dir), s="urn:customer:7"))


@query(quads_sql() + f"select {_SHOW} from q where o_text = 'urn:nation:3' and o_kind = 'iri'")
def scan_by_object(spark, sf_dir):
    return plain(S.scan(quads(spark, sf_dir), o="urn:nation:3"))


@query(quads_sql() + f"select {_SHOW} from q where p = 'urn:p:segment' and o_text = 'BUILDING' and o_kind = 'lit'")
def scan_by_literal(spark, sf_dir):
    return plain(S.scan(quads(spark, sf_dir), p=P + "segment", o=lit("BUILDING")))


@query(quads_sql("vip", "default") + f"select {_SHOW} from q")
def scan_in_graphs(spark, sf_dir):
    """A repeated graph and an unknown one change nothing; None is the default graph."""
    return plain(S.scan(quads(spark, sf_dir), contexts=[G + "vip", None, G + "vip", "urn:g:unknown"]))


@query(quads_sql("default") + f"select {_SHOW} from q")
def scan_default_graph(spark, sf_dir):
    return plain(S.scan(quads(spark, sf_dir), contexts=[None]))


@query(quads_sql() + "select count(*) > 0 as result from q where s = 'urn:order:11' and p = 'urn:p:placedBy'")
def has_statement_yes(spark, sf_dir):
    return S.has_statement(quads(spark, sf_dir), s="urn:order:11", p=P + "placedBy")


@query(quads_sql("vip") + "select count(*) > 0 as result from q where p = 'urn:p:placedBy'")
def has_statement_no(spark, sf_dir):
    return S.has_statement(quads(spark, sf_dir), p=P + "placedBy", contexts=[G + "vip"])


@query(quads_sql() + "select count(*) = 0 as result from q")
def is_empty(spark, sf_dir):
    return S.is_empty(quads(spark, sf_dir))


@query(quads_sql() + "select count(*) as n from q")
def count_all(spark, sf_dir):
    return S.count_all(quads(spark, sf_dir))


@query(quads_sql("customer", "default") + "select count(*) as n from q")
def count_in_graphs(spark, sf_dir):
    return S.count_in(quads(spark, sf_dir), [G + "customer", None, G + "customer"])


@query(quads_sql("default") + "select count(*) as n from q")
def count_in_empty_list(spark, sf_dir):
    """An empty list of graphs means the default graph."""
    return S.count_in(quads(spark, sf_dir), [])


@query(quads_sql() + "select g, count(*) as n from q group by g")
def count_per_graph(spark, sf_dir):
    return S.count_per_graph(quads(spark, sf_dir))


@query(quads_sql() + "select distinct g from q union select 'urn:g:registered' order by g")
def list_graphs(spark, sf_dir):
    registered = spark.createDataFrame([("urn:g:registered",)], "g string")
    return S.list_graphs(quads(spark, sf_dir), registered)


@query(quads_sql("orders", "default") + "select g, s, p, o_text, o_kind, o_num, o_time from q where p = 'urn:p:date' or p = 'urn:p:name'")
def export_filtered(spark, sf_dir):
    q = quads(spark, sf_dir)
    dates = S.export(q, p=P + "date", contexts=[G + "orders"])
    names = S.export(q, p=P + "name", contexts=[V.DEFAULT_GRAPH])
    return plain(dates.union(names)).where(F.col("g").isNotNull())

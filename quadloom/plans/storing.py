"""Registered queries: readers, writers, normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions import terms as T
from quadloom.functions.quad_columns import normalize
from quadloom.operators.patterns import bgp, pattern
from quadloom.operators.scan import count_per_graph
from quadloom.plans.mapping import G, P, quads, table
from quadloom.plans.registry import plain, quads_sql, query
from quadloom.session import scratch_path
from quadloom.sources import readers, sinks


@query(quads_sql("customer", "part", "default", "orders") + "select g, s, p, o_text, o_kind, o_num, o_time from q")
def read_nquads_roundtrip(spark, sf_dir):
    """Quads written as N-Quads and read back: graphs, datatypes and values survive."""
    path = scratch_path(spark, "nquads")
    source = quads(spark, sf_dir).limited(graphs=[G + "customer", G + "part", G + "orders", V.DEFAULT_GRAPH])
    sinks.write_nquads(source.df, path)
    return plain(readers.load(spark, path, "nquads"))


@query("""
select 'urn:doc:' || doc_id as s, text as o, md5(text) as hash, length(text) as n from documents
""")
def read_ntriples_texts(spark, sf_dir):
    """Whole document texts as literals: quotes, newlines and backslashes are escaped and come back."""
    docs = table(spark, sf_dir, "documents")
    raw = docs.select(
        F.lit(None).cast("string").alias("g"),
        F.concat(F.lit("urn:doc:"), "doc_id").alias("s"),
        F.lit(P + "text").alias("p"),
        F.col("text").alias("o"),
        F.lit("lit").alias("o_kind"),
        F.lit(None).cast("string").alias("o_dt"),
        F.lower("lang").alias("o_lang"),
    )
    path = scratch_path(spark, "ntriples")
    sinks.write_nquads(normalize(raw), path)
    back = readers.load(spark, path, "ntriples")
    return back.select("s", "o", F.md5("o").alias("hash"), F.length("o").cast("long").alias("n"))


@query("""
select 'urn:g:a' as g, 'urn:supplier:' || s_suppkey as s, s_name as o from supplier
union all select 'urn:x-default-graph', 'urn:supplier:' || s_suppkey, s_name from supplier
""")
def read_into_contexts(spark, sf_dir):
    """A triple file loaded into two graphs."""
    path = scratch_path(spark, "contexts")
    names = pattern(quads(spark, sf_dir), "?s", P + "name", "?o", graph=G + "supplier")
    rows = names.select(value=F.concat(F.lit("<"), "s", F.lit(f'> <{P}name> "'), "o", F.lit('" .')))
    rows.write.text(path)
    return readers.load(spark, path, "ntriples", contexts=["urn:g:a", None]).select("g", "s", "o")


@query("""
select 'urn:part:' || p_partkey as s, 'urn:p:brand' as p, p_brand as o, 'lit' as o_kind, null::double as num from part
union all select 'urn:part:' || p_partkey, 'urn:p:size', p_size::varchar, 'lit', p_size from part
union all select 'urn:part:' || p_partkey, 'urn:p:kind', 'urn:class:' || p_type, 'iri', null from part
""")
def read_rdfjson(spark, sf_dir):
    """RDF/JSON, one object per line, built from the parts and read back."""
    part = table(spark, sf_dir, "part")

    def values(value, kind, datatype=None):
        return F.array(
            F.struct(
                value.alias("value"),
                F.lit(kind).alias("type"),
                F.lit(datatype).cast("string").alias("datatype"),
            )
        )

    predicates = F.create_map(
        F.lit(P + "brand"), values(F.col("p_brand"), "literal"),
        F.lit(P + "size"), values(F.col("p_size").cast("string"), "literal", V.XSD_INT),
        F.lit(P + "kind"), values(F.concat(F.lit("urn:class:"), "p_type"), "uri"),
    )
    doc = F.to_json(F.create_map(F.concat(F.lit("urn:part:"), F.col("p_partkey").cast("string")), predicates))
    path = scratch_path(spark, "rdfjson")
    part.select(doc.alias("value")).write.text(path)
    back = readers.load(spark, path, "rdfjson", multiline=False)
    return back.select("s", "p", "o", "o_kind", F.col("o_num").alias("num"))


@query("""
select doc_id::varchar as doc_id, 'urn:doc:' || doc_id as s, 'urn:p:chars' as p, n_chars::double as num, null as o from documents
union all select doc_id::varchar, 'urn:doc:' || doc_id, 'urn:p:lang', null, lang from documents
""")
def read_embedded_xml(spark, sf_dir):
    """Triples embedded in XML documents keep the document they came from."""
    docs = table(spark, sf_dir, "documents")

    def triple(p, value, dt):
        return F.concat(
            F.lit("<sem:triple><sem:subject>urn:doc:"), F.col("doc_id").cast("string"),
            F.lit(f"</sem:subject><sem:predicate>{p}</sem:predicate><sem:object datatype=\"{dt}\">"),
            value, F.lit("</sem:object></sem:triple>"),
        )

    # the text itself travels along as another element, with its markup escaped
    text = F.regexp_replace("text", r"[^\x09\x0A\x0D\x20-퟿-�]", " ")
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    xml = F.concat(
        F.lit("<doc><title>"), text, F.lit('</title><sem:triples xmlns:sem="urn:x-sem">'),
        triple(P + "chars", F.col("n_chars").cast("string"), V.XSD_INTEGER),
        triple(P + "lang", F.col("lang"), V.XSD_STRING),
        F.lit("</sem:triples></doc>"),
    )
    found = readers.extract_embedded(docs.select("doc_id", xml.alias("xml")))
    return found.select("doc_id", "s", "p", F.col("o_num").alias("num"), F.when(F.col("o_num").isNull(), F.col("o")).alias("o"))


def _typed_lines(spark, sf_dir):
    """A file with one bad literal per event whose type is 'error'."""
    events = table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", F.lit("not-a-number")).otherwise(F.col("value").cast("string"))
    line = F.concat(
        F.lit("<urn:event:"), F.col("event_id").cast("string"), F.lit(f'> <{P}value> "'), value,
        F.lit(f'"^^<{V.XSD_DOUBLE}> .'),
    )
    path = scratch_path(spark, "typed")
    events.select(line.alias("value")).write.text(path)
    return path


@query("select 'urn:event:' || event_id as s, value as num from events where event_type <> 'error'")
def drop_malformed(spark, sf_dir):
    path = _typed_lines(spark, sf_dir)
    return readers.load(spark, path, "ntriples", mode=readers.DROP).select("s", F.col("o_num").alias("num"))


@query("select 'malformed literal' as problem, count(*) as n from events where event_type = 'error'")
def quarantine_malformed(spark, sf_dir):
    """What was left out, and why."""
    bad = readers.malformed(spark, _typed_lines(spark, sf_dir), "ntriples")
    return bad.groupBy("problem").agg(F.count("line").alias("n"))


@query("""
select 'urn:x-blank:user' || user_id as s, 'urn:x-blank:event' || event_id as o from events
""")
def skolemize(spark, sf_dir):
    """The same blank-node id always becomes the same IRI."""
    events = table(spark, sf_dir, "events")
    s, o = (F.concat(F.lit("_:" + n), F.col(c).cast("string")) for n, c in (("user", "user_id"), ("event", "event_id")))
    return events.select(T.skolemize(s).alias("s"), T.skolemize(o).alias("o"))


@query("""
select url, case
when page_id % 7 = 0 then 'http://example.org/a/b/p' || page_id
when page_id % 7 = 1 then 'http://example.org/a/p' || page_id
when page_id % 7 = 2 then 'http://example.org/p' || page_id
when page_id % 7 = 3 then 'http://example.org/a/b/c?q=1#f' || page_id
when page_id % 7 = 4 then 'http://other/x' || page_id
when page_id % 7 = 5 then 'http://example.org/a/b/c?k=' || page_id
else url end as resolved
from pages
""")
def resolve_iri(spark, sf_dir):
    """Relative references of every kind against a base; the pages' own URLs are absolute."""
    pages = spark.read.schema("page_id long, url string, html string").parquet(f"{sf_dir}/pages.parquet")
    n = F.col("page_id").cast("string")
    prefixes = ["p", "../p", "/x/./../p", "#f", "//other/x", "?k="]
    ref = F.col("url")
    for i, prefix in enumerate(prefixes):
        ref = F.when(F.col("page_id") % 7 == i, F.concat(F.lit(prefix), n)).otherwise(ref)
    return pages.select("url", T.resolve_iri(ref, "http://example.org/a/b/c?q=1#top").alias("resolved"))


@query("""
select '<urn:customer:' || c_custkey || '> <urn:p:segment> "' || c_mktsegment || '" <urn:g:customer> .' as line
from customer
""")
def export_nquads_lines(spark, sf_dir):
    q = quads(spark, sf_dir).match(p=P + "segment", graphs=[G + "customer"])[0]
    return sinks.nquads_lines(q).select(F.col("value").alias("line"))


@query("""
select '{"c":{"type":"uri","value":"urn:customer:' || c_custkey || '"},"segment":{"type":"literal","value":"'
|| c_mktsegment || '"}' || case when c_acctbal > 5000 then ',"vip":{"type":"literal","value":"true"}' else '' end || '}' as row
from customer
""")
def export_json_bindings(spark, sf_dir):
    """Unbound variables are left out of the row."""
    q = quads(spark, sf_dir)
    base = pattern(q, "?c", P + "segment", "?segment", graph=G + "customer")
    sol = base.optional(pattern(q, "?c", P + "vip", "?vip", graph=G + "customer"))
    return sinks.json_bindings(sol, ["c", "segment", "vip"]).select(F.col("value").alias("row"))


@query("""
select '<result><binding name="part"><uri>urn:part:' || p_partkey || '</uri></binding><binding name="size"><literal datatype="http://www.w3.org/2001/XMLSchema#integer">'
|| p_size || '</literal></binding></result>' as row from part
""")
def export_xml_bindings(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?part", P + "size", "?size", graph=G + "part")
    return sinks.xml_bindings(sol).select(F.col("value").alias("row"))


@query("""
select '<urn:part:' || p_partkey || '>' || chr(9) || '"' || p_name || '"' || chr(9) || '"' || p_size
|| '"^^<http://www.w3.org/2001/XMLSchema#integer>' as row from part
""")
def export_tsv_rows(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?part", P + "name", "?name"), ("?part", P + "size", "?size")], graph=G + "part")
    return sinks.tsv_rows(sol, ["part", "name", "size"]).select(F.col("value").alias("row"))


@query("select 'urn:part:' || p_partkey as part, p_name as name from part")
def export_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    sol = pattern(quads(spark, sf_dir), "?part", P + "name", "?name", graph=G + "part")
    sinks.write_csv(sol, path, ["part", "name"])
    return spark.read.schema("part string, name string").option("header", True).option("escape", '"').csv(path)


@query(quads_sql() + "select g, count(*) as n from q group by g")
def bulk_load(spark, sf_dir):
    """All mapped quads written in one pass per table, then counted from the files."""
    path = scratch_path(spark, "bulk")
    sinks.write_parquet(quads(spark, sf_dir).stacked(), path)
    schema = "g string, s string, o string, o_kind string, p string"
    return count_per_graph(spark.read.schema(schema).parquet(path))


@query("""
select 'urn:customer:' || c_custkey as s, 'urn:p:name' as p, c_name as o from customer
union all select 'urn:customer:' || c_custkey, 'urn:p:note', 'a "quoted" {brace} of ' || c_mktsegment || ', \\ and }' from customer
union all select 'urn:customer:' || c_custkey, 'urn:p:inNation', 'urn:nation:' || c_nationkey from customer
""")
def read_rdfjson_large(spark, sf_dir):
    """One RDF/JSON file with all customers, cut at its subjects by many tasks; strings with braces, quotes and backslashes."""
    customers = table(spark, sf_dir, "customer")

    def values(value, kind):
        return F.array(F.struct(value.alias("value"), F.lit(kind).alias("type")))

    note = F.concat(F.lit('a "quoted" {brace} of '), "c_mktsegment", F.lit(", \\ and }"))
    predicates = F.create_map(
        F.lit(P + "name"), values(F.col("c_name"), "literal"),
        F.lit(P + "note"), values(note, "literal"),
        F.lit(P + "inNation"), values(F.concat(F.lit("urn:nation:"), F.col("c_nationkey").cast("string")), "uri"),
    )
    member = F.concat(F.lit('"urn:customer:'), F.col("c_custkey").cast("string"), F.lit('" : '), F.to_json(predicates), F.lit(" ,"))
    ends = spark.createDataFrame([(-1, "{"), (2**62, '"urn:nobody": {}\n}')], "n long, value string")
    lines = customers.select(F.col("c_custkey").alias("n"), member.alias("value")).union(ends)
    path = scratch_path(spark, "rdfjson")
    lines.coalesce(1).sortWithinPartitions("n").select("value").write.text(path)
    return readers.load(spark, path, "rdfjson").select("s", "p", "o")

"""Registered queries: document-constrained queries and graph permissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.operators import constraints as C
from quadloom.operators import forms
from quadloom.operators import permissions as A
from quadloom.operators.patterns import bgp, num
from quadloom.operators.scan import count_per_graph
from quadloom.plans.mapping import G, P, quads, table
from quadloom.plans.registry import plain, quads_sql, query
from quadloom.session import scratch_path
from quadloom.sources.snapshots import SnapshotStore

# Buckets over the length of a text, as (from, below).
SIZES = {"high": (2000, None), "medium": (500, 2000), "low": (None, 500)}


def _documents(spark, sf_dir):
    """The corpus: the source is the directory, the language the collection."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        "text",
        "n_chars",
        F.concat(F.lit("/"), "source", F.lit("/"), "doc_id", F.lit(".xml")).alias("uri"),
        F.array("lang").alias("collections"),
    )


def _quads(spark, sf_dir):
    return quads(spark, sf_dir).limited(graphs=[G + "documents"])


_WORD = r"(^|[^\p{L}\p{N}])%s($|[^\p{L}\p{N}])"


def _matching(where: str) -> str:
    return quads_sql("documents") + f"""
select g, s, p, o_text, o_kind, o_num, o_time from q
where s in (select 'urn:doc:' || doc_id from documents where {where})"""


@query(_matching(f"regexp_matches(lower(text), '{_WORD % 'the'}') and regexp_matches(lower(text), '{_WORD % 'for'}')"))
def constrain_text(spark, sf_dir):
    """Quads of the documents that hold all words of a search string."""
    return plain(C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), C.text_search("The for")))


@query(_matching(f"regexp_matches(lower(text), '{_WORD % 'queque'}')"))
def constrain_term(spark, sf_dir):
    return plain(C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), C.term_query("QUEQUE")))


@query(_matching("true"))
def constrain_match_all(spark, sf_dir):
    return plain(C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), C.text_search("*")))


@query(_matching("n_chars >= 2000"))
def constrain_bucket(spark, sf_dir):
    return plain(C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), C.in_bucket("n_chars", SIZES, "high")))


@query("""
select case when n_chars >= 2000 then 'high' when n_chars >= 500 then 'medium' else 'low' end as bucket, count(*) as n
from documents group by 1
""")
def bucket_counts(spark, sf_dir):
    docs = _documents(spark, sf_dir).withColumn("bucket", C.bucket("n_chars", SIZES))
    return docs.groupBy("bucket").agg(F.count("doc_id").alias("n"))


@query(_matching("source = 'src1'"))
def constrain_directory(spark, sf_dir):
    """A directory is not a prefix of its siblings: /src1 does not hold /src10."""
    return plain(C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), C.in_directory("/src1")))


@query(_matching("lang in ('de', 'fr')"))
def constrain_collection(spark, sf_dir):
    return plain(C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), C.in_collections(["de", "fr"])))


@query(f"""
select lang, count(*) as n, max(n_chars)::double as longest from documents
where regexp_matches(lower(text), '{_WORD % 'the'}') and n_chars < 2000 and n_chars >= 500 group by lang
""")
def constrained_pattern(spark, sf_dir):
    """A pattern over the quads of constrained documents, then grouped."""
    cond = C.text_search("the") & C.in_bucket("n_chars", SIZES, "medium")
    visible = C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), cond)
    sol = bgp(visible, [("?d", P + "lang", "?lang"), ("?d", P + "chars", "?n")], graph=G + "documents")
    return sol.df.groupBy("lang").agg(F.count("d").alias("n"), F.max(num("n")).alias("longest"))


@query(f"""
select 'default' as kind, count(*) as n from documents where lang = 'de'
union all select 'own', count(*) from documents where regexp_matches(lower(text), '{_WORD % 'the'}')
union all select 'cleared', count(*) from documents
union all select 'transformed', count(distinct source) from documents where lang = 'de'
""")
def constraint_defaults(spark, sf_dir):
    """A default constraint, one of the query's own, none, and a result transform."""
    q, docs = _quads(spark, sf_dir), _documents(spark, sf_dir)
    default = C.in_collections(["de"])

    def count(df, kind):
        chars = df.where(F.col("p") == P + "source")
        return chars.agg(F.count("s").alias("n")).select(F.lit(kind).alias("kind"), "n")

    def one_per_source(df):
        return df.where(F.col("p") == P + "source").dropDuplicates(["p", "o"])

    out = count(C.constrained(q, docs, default=default), "default")
    out = out.union(count(C.constrained(q, docs, C.text_search("the"), default=default), "own"))
    out = out.union(count(C.constrained(q, docs, default=default, clear=True), "cleared"))
    return out.union(count(C.constrained(q, docs, default=default, transform=one_per_source), "transformed"))


@query("select count(*) > 0 as result from documents where doc_id = 3 and source = 'no such source'")
def constrained_ask(spark, sf_dir):
    """ASK over a directory without documents."""
    visible = C.constrain(_quads(spark, sf_dir), _documents(spark, sf_dir), C.in_directory("/no such source"))
    return forms.ask(bgp(visible, [("urn:doc:3", P + "lang", "?l")]))


# -- permissions -----------------------------------------------------------------


def _permissions(spark):
    return A.permissions(
        spark,
        [
            (G + "customer", "staff", "read"),
            (G + "customer", "staff", "update"),
            (G + "vip", "manager", "READ"),
            (G + "orders", "staff", "execute"),
            (V.DEFAULT_GRAPH, "guest", "read"),
        ],
    )


@query(quads_sql("customer", "default") + "select g, s, p, o_text, o_kind, o_num, o_time from q")
def perms_visible(spark, sf_dir):
    """Only graphs one of the roles may read; another capability does not help."""
    return plain(A.visible(quads(spark, sf_dir), _permissions(spark), ["staff", "guest"]))


@query("select distinct 'urn:g:vip' as g from customer where c_acctbal > 5000 union select 'urn:g:orders' from orders")
def perms_write_check(spark, sf_dir):
    """Graphs of a change that the roles may not update."""
    change = quads(spark, sf_dir).limited(graphs=[G + "customer", G + "vip", G + "orders"]).df
    return A.denied_graphs(change, _permissions(spark), ["staff"])


@query("""
select * from (values ('urn:g:customer','staff','READ'),('urn:g:customer','staff','UPDATE'),('urn:g:vip','manager','READ'),
('urn:g:orders','staff','EXECUTE'),('urn:x-default-graph','guest','READ')) t(g, role, capability)
union select g, role, capability from (select distinct 'urn:g:supplier' as g from supplier),
(values ('buyer','READ'),('buyer','UPDATE')) v(role, capability)
""")
def perms_granted_on_write(spark, sf_dir):
    """Permissions set together with a change apply to the graphs it writes."""
    change = quads(spark, sf_dir).limited(graphs=[G + "supplier"]).df
    return A.grant(_permissions(spark), change, [("buyer", "read"), ("buyer", "update")])


@query(quads_sql("vip") + "select g, count(*) as n from q group by g")
def perms_visible_counts(spark, sf_dir):
    visible = A.visible(quads(spark, sf_dir), _permissions(spark), ["manager"])
    return count_per_graph(visible)


def _guarded(spark, sf_dir):
    """Stored customers and suppliers: the first with grants of their own, the others with the store's."""
    path = scratch_path(spark, "store")
    store = SnapshotStore(spark, path, grants=[("buyer", "read")])
    q = quads(spark, sf_dir)
    store.add(q.limited(graphs=[G + "customer"]).df, grants=[("staff", "read"), ("staff", "update")])
    store.add(q.limited(graphs=[G + "supplier"]).df)
    return path


@query("""
select 'urn:g:customer' as g, 'staff' as role, c as capability from (select count(*) as n from customer), (values ('READ'), ('UPDATE')) t(c) where n > 0
union all select 'urn:g:supplier', 'buyer', 'READ' from (select count(*) as n from supplier) where n > 0
""")
def perms_stored(spark, sf_dir):
    """Permissions are kept with the stored quads: a write's own ones, or the store's."""
    return SnapshotStore(spark, _guarded(spark, sf_dir)).permissions()


@query(quads_sql("supplier") + "select g, s, p, o_text, o_kind, o_num, o_time from q")
def perms_default(spark, sf_dir):
    """A role sees the graphs that the store's default grants open to it, and no others."""
    return plain(SnapshotStore(spark, _guarded(spark, sf_dir), roles=["buyer"]).visible())

"""Registered queries: a text index, quads that several documents give, lookups in stored quads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import with_values
from quadloom.operators import constraints as C
from quadloom.operators.membership import documents_per_quad
from quadloom.operators.patterns import bgp, num, pattern
from quadloom.operators.scan import scan
from quadloom.operators.updates import Store, distinct_quads
from quadloom.plans.documents import SIZES, _documents, _quads, _WORD
from quadloom.plans.mapping import G, P, SCHEMAS, quads, table
from quadloom.plans.registry import plain, query, quads_sql
from quadloom.session import scratch_path
from quadloom.sources.snapshots import SnapshotStore
from quadloom.sources.textindex import TextIndex
from quadloom.streaming.buffered import DELETE, INSERT, BufferOptions, change_stream, insert_stream


def _index(spark, sf_dir) -> TextIndex:
    return TextIndex(spark, scratch_path(spark, "index")).build(table(spark, sf_dir, "documents"))


def _holds(*words: str) -> str:
    return " and ".join(f"regexp_matches(lower(text), '{_WORD % w}')" for w in words)


@query(f"select doc_id::varchar as doc_id from documents where {_holds('the', 'for')}")
def search_index_words(spark, sf_dir):
    """The documents with all words of a search string, from the index alone."""
    return _index(spark, sf_dir).search("The for")


@query(f"""
select doc_id::varchar as doc_id, 'all' as kind from documents where {_holds('the', 'que', 'und')}
union all select doc_id::varchar, 'rare' from documents where {_holds('the', 'for', 'queque')}
union all select doc_id::varchar, 'unknown' from documents where {_holds('the', 'nosuchword')}
""")
def search_index_rare_first(spark, sf_dir):
    """Words of different frequency: the list of the rarest one leads, and an unknown word ends the search."""
    index = _index(spark, sf_dir)
    searches = {"all": "the que und", "rare": "the for queque", "unknown": "the nosuchword"}
    return reduce(DataFrame.union, [index.search(q).select("doc_id", F.lit(k).alias("kind")) for k, q in searches.items()])


@query(f"""
select doc_id::varchar as doc_id from documents
where {_holds('the')} and ({_holds('und')} or {_holds('que')}) and not ({_holds('for')})
""")
def search_index_combined(spark, sf_dir):
    """All, any and none of some words."""
    return _index(spark, sf_dir).search("the", any_of=["und", "que"], none_of="for")


@query(f"""
with q as (select word, count(distinct doc_id) as n from (
  select doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) as word from documents) where word <> '' group by word)
select word, n from q where n >= 2
""")
def search_index_frequencies(spark, sf_dir):
    """How many documents hold each word, those of one document left out; a second part of the documents is added later."""
    docs = table(spark, sf_dir, "documents")
    index = TextIndex(spark, scratch_path(spark, "index"))
    index.build(docs.where("lang = 'en'")).extend(docs.where("lang <> 'en'"))
    return index.word_counts().where("n >= 2")


@query(
    quads_sql("documents")
    + f"select g, s, p, o_text, o_kind, o_num, o_time from q where s in (select 'urn:doc:' || doc_id from documents where {_holds('the', 'for')} and n_chars >= 2000)"
)
def constrain_by_index(spark, sf_dir):
    """Quads of the documents that a search finds and that are long enough."""
    docs = _documents(spark, sf_dir).where(C.in_bucket("n_chars", SIZES, "high")).drop("text")
    found = _index(spark, sf_dir).search("The for")
    return plain(C.constrain_to(_quads(spark, sf_dir), docs.join(found, docs["doc_id"].cast("string") == found["doc_id"], "left_semi")))


# -- quads that several documents give ----------------------------------------------


def _languages(spark, sf_dir) -> DataFrame:
    """What every document says about its source: a source and its languages are given by many documents."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        F.lit(G + "sources").alias("g"),
        F.concat(F.lit("urn:source:"), "source").alias("s"),
        F.lit(P + "writtenIn").alias("p"),
        F.col("lang").alias("o"),
        F.lit("lit").alias("o_kind"),
        F.lit(V.XSD_STRING).alias("o_dt"),
        F.lit(None).cast("string").alias("o_lang"),
        F.col("doc_id").cast("string").alias("doc_id"),
    )
    return with_values(rows.where("s is not null and o is not null"))


_KINDS = {
    "all words": _holds("the", "for"),
    "term": _holds("queque"),
    "every": "true",
    "bucket": "n_chars >= 2000",
    "directory": "source = 'src1'",
    "collection": "lang in ('de', 'fr')",
}


@query(" union all ".join(
    f"select distinct '{kind}' as kind, 'urn:source:' || source as s, lang as o from documents where source is not null and lang is not null and {where}"
    for kind, where in _KINDS.items()
))
def constrain_shared_quads(spark, sf_dir):
    """Every kind of constraint finds a quad by each of the documents that give it; the quads are stored as a set."""
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.add(_languages(spark, sf_dir))
    q, members, docs = store.read(), store.members(), _documents(spark, sf_dir)
    conditions = {
        "all words": C.text_search("The for"),
        "term": C.term_query("QUEQUE"),
        "every": C.text_search("*"),
        "bucket": C.in_bucket("n_chars", SIZES, "high"),
        "directory": C.in_directory("/src1"),
        "collection": C.in_collections(["de", "fr"]),
    }
    found = [C.constrain(q, docs, c, members).select(F.lit(k).alias("kind"), "s", "o") for k, c in conditions.items()]
    return reduce(DataFrame.union, found)


@query("""
select 'urn:source:' || source as s, lang as o, count(*) as n from documents
where source is not null and lang is not null and doc_id % 2 = 0 group by all
""")
def members_after_removal(spark, sf_dir):
    """Documents of quads through several writes: what was given before a removal is forgotten, and only that."""
    rows = _languages(spark, sf_dir)
    even = F.col("doc_id").cast("long") % 2 == 0
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.add(rows.where(~even))
    store.remove(p=P + "writtenIn")
    store.add(rows.where(even & (F.col("doc_id").cast("long") % 4 == 0)))
    store.add(rows.where(even))
    return documents_per_quad(store.members()).select("s", "o", "n")


@query("""
select 'urn:source:' || source as s, lang as o, count(distinct doc_id) as n from documents
where source is not null and lang is not null group by all
""")
def members_of_updates(spark, sf_dir):
    """In-plan updates keep all documents of a quad, whether it was there before or not."""
    rows = _languages(spark, sf_dir)
    first = F.col("doc_id").cast("long") % 3 == 0
    state = Store(distinct_quads(rows.where(first))).add(rows.where(first)).add(rows.where(~first))
    return documents_per_quad(state.members).select("s", "o", "n")


@query("""
with last_off as (select user_id, event_type, max(event_id) as off from events where value < 10 group by all)
select 'urn:user:' || e.user_id as s, e.event_type as o, 'day' || (e.event_id % 3) as doc
from events e left join last_off l on e.user_id = l.user_id and e.event_type = l.event_type
where e.value >= 10 and (l.off is null or e.event_id > l.off) group by all
""")
def members_of_stream(spark, sf_dir):
    """A stream of changes: a quad belongs to all documents that gave it since it was last removed."""
    events = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    changes = events.select(
        F.lit(G + "events").alias("g"),
        F.concat(F.lit("urn:user:"), F.col("user_id").cast("string")).alias("s"),
        F.lit(P + "does").alias("p"),
        F.col("event_type").alias("o"),
        F.lit("lit").alias("o_kind"),
        F.lit(V.XSD_STRING).alias("o_dt"),
        F.lit(None).cast("string").alias("o_lang"),
        F.concat(F.lit("day"), (F.col("event_id") % 3).cast("string")).alias("doc_id"),
        F.when(F.col("value") >= 10, F.lit(INSERT)).otherwise(F.lit(DELETE)).alias("op"),
        F.col("event_id").alias("seq"),
    )
    store = SnapshotStore(spark, scratch_path(spark, "events"))
    change_stream(changes, store, scratch_path(spark, "offsets")).awaitTermination()
    return store.members().select("s", "o", F.col("doc_id").alias("doc"))


# -- stored quads ---------------------------------------------------------------------


def _stored(spark, sf_dir, *graphs) -> SnapshotStore:
    store = SnapshotStore(spark, scratch_path(spark, "store"), copies=("s", "o"))
    store.add(quads(spark, sf_dir).limited(graphs=list(graphs)).df)
    return store


@query("""
select 'object' as kind, 'urn:order:' || o_orderkey as s, 'urn:p:placedBy' as p, 'urn:customer:1' as o from orders where o_custkey = 1
union all select 'literal', 'urn:customer:' || c_custkey, 'urn:p:segment', c_mktsegment from customer where c_mktsegment = 'BUILDING'
union all select 'subject', 'urn:customer:7', 'urn:p:segment', c_mktsegment from customer where c_custkey = 7
union all select 'subject', 'urn:customer:7', 'urn:p:name', c_name from customer where c_custkey = 7
union all select 'subject', 'urn:customer:7', 'urn:p:inNation', 'urn:nation:' || c_nationkey from customer where c_custkey = 7
union all select 'subject', 'urn:customer:7', 'urn:p:vip', 'true' from customer where c_custkey = 7 and c_acctbal > 5000
""")
def stored_lookup_by_object(spark, sf_dir):
    """Stored quads of an object, a literal and a subject: each opens one folder of the order that fits."""
    q = _stored(spark, sf_dir, G + "orders", G + "customer").quads()
    found = {
        "object": scan(q, o="urn:customer:1"),
        "literal": scan(q, o=lit("BUILDING")),
        "subject": scan(q, s="urn:customer:7").where(F.col("p") != P + "acctbal"),
    }
    return reduce(DataFrame.union, [df.select(F.lit(k).alias("kind"), "s", "p", "o") for k, df in found.items()])


@query("""
select 'urn:order:' || o_orderkey as o, o_totalprice as total, c_name as name
from orders join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING' and o_orderstatus = 'F'
""")
def stored_pattern_lookup(spark, sf_dir):
    """A graph pattern over stored quads; literal objects are looked up in the order by object, predicates in the store's own."""
    q = _stored(spark, sf_dir, G + "orders", G + "customer").quads()
    patterns = [
        ("?o", P + "status", lit("F")), ("?o", P + "placedBy", "?c"), ("?c", P + "segment", lit("BUILDING")),
        ("?o", P + "total", "?t"), ("?c", P + "name", "?name"),
    ]
    return bgp(q, patterns, merge=False).select("o", "name", total=num("t"))


@query("""
select 'urn:customer:3' as s, 'urn:p:name' as p, c_name as o from customer where c_custkey = 3
union all select 'urn:customer:3', 'urn:p:segment', c_mktsegment from customer where c_custkey = 3
union all select 'urn:customer:3', 'urn:p:inNation', 'urn:nation:' || c_nationkey from customer where c_custkey = 3
""")
def stored_subject_after_removal(spark, sf_dir):
    """The orders by subject and object follow removals."""
    store = _stored(spark, sf_dir, G + "customer", G + "vip")
    store.clear([G + "vip"])
    store.remove(s="urn:customer:3", p=P + "acctbal")
    store.remove(p=P + "vip")
    return scan(store.quads(), s="urn:customer:3").select("s", "p", "o")


@query("select distinct 'urn:user:' || user_id as s, event_type as o from events")
def stream_insert_limited(spark, sf_dir):
    """A buffer that writes at most some thousand quads at once; the parts of a batch are folders of their own."""
    events = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = events.select(
        F.lit(G + "events").alias("g"),
        F.concat(F.lit("urn:user:"), F.col("user_id").cast("string")).alias("s"),
        F.lit(P + "did").alias("p"),
        F.col("event_type").alias("o"),
        F.lit("lit").alias("o_kind"),
        F.lit(V.XSD_STRING).alias("o_dt"),
        *[F.lit(None).cast("string").alias(c) for c in ("o_lang", "doc_id")],
    )
    store = SnapshotStore(spark, scratch_path(spark, "events"))
    insert_stream(with_values(rows), store, scratch_path(spark, "offsets"), BufferOptions(max_rows=20_000)).awaitTermination()
    return store.read().select("s", "o")


@query("""
select 'urn:order:' || o_orderkey as s, 'status' as kind, o_orderstatus as o from orders
union all select distinct 'urn:customer:' || c_custkey, 'segment', c_mktsegment from customer
""")
def no_dataset_catalogued(spark, sf_dir):
    """Patterns over all graphs of a store: the catalogue tells which predicate can repeat a triple in two graphs."""
    store = SnapshotStore(spark, scratch_path(spark, "store"), catalogue=True)
    for graph in ("orders", "customer", "vip"):
        store.add(quads(spark, sf_dir).limited(graphs=[G + graph]).df)
    q = store.quads()
    found = [pattern(q, "?s", P + name, "?o").select("s", F.lit(name).alias("kind"), "o") for name in ("status", "segment")]
    return found[0].union(found[1])

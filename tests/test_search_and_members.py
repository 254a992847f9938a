"""Text index, documents of quads, rule table, groups of names, stored orders, buffer limits."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import statements
from quadloom.operators import constraints as C
from quadloom.operators import inference as I
from quadloom.operators.groups import equivalence_groups
from quadloom.operators.membership import documents_per_quad
from quadloom.operators.patterns import bgp, pattern
from quadloom.operators.scan import count_all, frame, scan
from quadloom.operators.updates import Store, distinct_quads
from quadloom.plans import QUERIES
from quadloom.session import scratch_path
from quadloom.sources.snapshots import SnapshotStore
from quadloom.sources.textindex import TextIndex, folder_of
from quadloom.streaming.buffered import BufferOptions, change_stream, insert_stream

DOCS = [
    ("1", "Alpha beta, GAMMA!"), ("2", "beta beta2 beta-gamma"), ("3", "Élan vital; naïve ALPHA"), ("4", None), ("5", ""),
    ("6", "alphabet gamma\ndelta_beta"), ("6", "alphabet gamma\ndelta_beta"), (None, "alpha beta gamma"),
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(DOCS, "doc_id string, text string").cache()


@pytest.fixture(scope="module")
def index(spark, documents):
    return TextIndex(spark, scratch_path(spark, "index")).build(documents)


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


# -- text index --------------------------------------------------------------------------


@pytest.mark.parametrize("query", ["alpha", "ALPHA beta", "gamma beta", "élan", "NAÏVE alpha", "beta2", "delta", "nosuch", "alpha nosuch"])
def test_index_finds_what_the_texts_hold(index, documents, query):
    held = documents.where("doc_id is not null").where(C.text_search(query)).select("doc_id").distinct()
    assert ids(index.search(query)) == ids(held)


def test_index_combinations(index):
    assert ids(index.search("gamma", any_of=["alpha", "alphabet"])) == ["1", "6"]
    assert ids(index.search("gamma", none_of="beta")) == []
    assert ids(index.search(any_of="beta2 vital")) == ["2", "3"]
    assert index.frequencies(["gamma", "beta", "x"]) == {"gamma": 3, "beta": 3, "x": 0}
    for nothing in ("", "*", "--"):
        with pytest.raises(ValueError):
            index.search(nothing)


def test_index_grows_and_is_replaced(spark, documents):
    index = TextIndex(spark, scratch_path(spark, "index"))
    assert index.frequencies(["alpha"]) == {"alpha": 0} and ids(index.search("alpha")) == []
    index.build(documents.where("doc_id = '1'")).extend(documents.where("doc_id = '3'"))
    assert index.frequencies(["alpha"]) == {"alpha": 2} and ids(index.search("alpha")) == ["1", "3"]
    index.build(documents.where("doc_id = '6'"))
    assert ids(index.search("alpha")) == [] and ids(index.search("gamma")) == ["6"]


def test_only_documents_of_several_rows_are_merged(spark, monkeypatch):
    import quadloom.sources.textindex as module

    once = spark.createDataFrame([("1", "a b a"), ("2", "b"), (None, "c"), ("3", None)], "doc_id string, text string")
    more = once.union(spark.createDataFrame([("2", "B d"), ("4", "e"), ("4", "e")], once.schema))
    held = lambda df: sorted((r["word"], r["doc_id"]) for r in df.collect())
    assert "Exchange" not in plan_of(module.postings_of(once))  # nothing is shuffled to merge pairs
    assert held(module.postings_of(once)) == [("a", "1"), ("b", "1"), ("b", "2")]
    want = [("a", "1"), ("b", "1"), ("b", "2"), ("d", "2"), ("e", "4")]
    for most in (module.BROADCAST_DOCS, 1):
        monkeypatch.setattr(module, "BROADCAST_DOCS", most)
        assert held(module.postings_of(more)) == want


def test_a_search_opens_the_folders_of_its_words_and_no_text(index):
    plan = plan_of(index.search("alpha gamma"))
    for word in ("alpha", "gamma"):
        assert folder_of(word) == hashlib.md5(word.encode()).hexdigest()[:2]
        assert re.search(rf"PartitionFilters: \[[^]]*\(wh#\d+ = {folder_of(word)}\)", plan)
    assert "text" not in plan.replace("textindex", "") and "Python" not in plan


def test_the_rarest_word_leads(index, monkeypatch):
    import quadloom.sources.textindex as module

    small = plan_of(index.search("beta2 gamma"))
    assert "BroadcastHashJoin" in small
    monkeypatch.setattr(module, "BROADCAST_DOCS", 0)
    assert ids(index.search("beta2 gamma")) == ["2"]


def test_constraint_by_a_search(spark, index):
    rows = [("urn:a", "urn:p", "urn:x", "urn:g")]
    q = statements(spark, rows).withColumn("doc_id", F.lit("3"))
    assert C.constrain_to(q, index.search("vital")).count() == 1
    assert C.constrain_to(q, index.search("beta")).count() == 0


# -- documents of a quad -----------------------------------------------------------------


def given(spark, *rows):
    """(s, doc) pairs: one quad per s, given by doc."""
    df = spark.createDataFrame([(s, d) for s, d in rows], "s string, doc string")
    return df.select(
        F.lit("urn:g").alias("g"), "s", F.lit("urn:p").alias("p"), F.lit("urn:o").alias("o"), F.lit("iri").alias("o_kind"),
        *[F.lit(None).cast("string").alias(c) for c in ("o_dt", "o_lang")], F.lit(None).cast("double").alias("o_num"),
        F.lit(None).cast("timestamp_ntz").alias("o_ts"), F.col("doc").alias("doc_id"),
    )


def pairs(members):
    return sorted((r["s"], r["doc_id"]) for r in members.collect())


SHARED = [("urn:a", "1"), ("urn:a", "2"), ("urn:a", "2"), ("urn:b", "2"), ("urn:c", None)]


def test_a_quad_is_found_by_each_of_its_documents(spark, documents):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.add(given(spark, *SHARED))
    q, members = store.read(), store.members()
    assert q.count() == 3 and pairs(members) == [("urn:a", "1"), ("urn:a", "2"), ("urn:b", "2")]

    def found(word):
        return sorted(r["s"] for r in C.constrain(q, documents, C.text_search(word), members).collect())

    assert found("alpha") == ["urn:a"] and found("beta2") == ["urn:a", "urn:b"] and found("vital") == []
    assert C.constrain(q, documents, None, members).count() == 3
    assert C.constrained(q, documents, default=C.term_query("beta2"), members=members).count() == 2
    counts = {r["s"]: r["n"] for r in documents_per_quad(members).collect()}
    assert counts == {"urn:a": 2, "urn:b": 1}


def test_members_through_removals_and_clearing(spark):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.add(given(spark, *SHARED))
    store.remove(s="urn:a")
    assert pairs(store.members()) == [("urn:b", "2")]
    store.add(given(spark, ("urn:a", "7"), ("urn:b", "8")))
    assert pairs(store.members()) == [("urn:a", "7"), ("urn:b", "2"), ("urn:b", "8")]
    assert store.read().count() == 3
    store.clear(["urn:g"])
    assert pairs(store.members()) == [] and store.read().count() == 0
    store.replace(given(spark, ("urn:z", "1"), ("urn:z", "2")))
    assert pairs(store.members()) == [("urn:z", "1"), ("urn:z", "2")] and store.read().count() == 1
    assert pairs(SnapshotStore(spark, scratch_path(spark, "none")).members()) == []


def test_members_of_in_plan_updates(spark):
    state = Store(distinct_quads(given(spark, *SHARED))).add(given(spark, *SHARED)).add(given(spark, ("urn:b", "9")))
    assert pairs(state.members) == [("urn:a", "1"), ("urn:a", "2"), ("urn:b", "2"), ("urn:b", "9")]
    assert pairs(state.remove(s="urn:b").members) == [("urn:a", "1"), ("urn:a", "2")]
    assert state.quads.count() == 3
    # the document that a merged row shows does not depend on the order of rows
    assert {r["s"]: r["doc_id"] for r in state.quads.collect()} == {"urn:a": "1", "urn:b": "2", "urn:c": None}


def test_members_of_a_stream_of_changes(spark):
    rows = given(spark, ("urn:a", "1"), ("urn:a", "2"), ("urn:a", "3"), ("urn:b", "4"), ("urn:b", "5"))
    order = {"1": ("insert", 1), "2": ("insert", 4), "3": ("insert", 5), "4": ("insert", 2), "5": ("delete", 9)}
    ops = F.create_map(*[x for d, (op, seq) in order.items() for x in (F.lit(d), F.struct(F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq")))])
    removed = given(spark, ("urn:a", "0")).withColumn("op", F.lit("delete")).withColumn("seq", F.lit(3).cast("long"))
    changes = rows.withColumn("x", ops[F.col("doc_id")]).select(*rows.columns, "x.op", "x.seq").unionByName(removed)
    folder = scratch_path(spark, "changes")
    changes.drop("o_num", "o_ts").write.parquet(folder)
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    change_stream(stream, store, scratch_path(spark, "offsets"), BufferOptions(max_rows=2)).awaitTermination()
    assert pairs(store.members()) == [("urn:a", "2"), ("urn:a", "3")]
    assert [r["s"] for r in store.read().collect()] == ["urn:a"]


# -- buffers and grants ------------------------------------------------------------------


def test_a_batch_is_written_in_parts_of_some_rows(spark):
    folder = scratch_path(spark, "rows")
    rows = given(spark, *[(f"urn:s{i % 60}", str(i)) for i in range(100)])
    rows.write.parquet(folder)
    stream = spark.readStream.schema(rows.schema).parquet(folder)
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    insert_stream(stream, store, scratch_path(spark, "offsets"), BufferOptions(max_rows=30)).awaitTermination()
    assert len([f for f in os.listdir(store.path) if f.startswith("batch=")]) == 4
    assert store.read().count() == 60 and store.members().count() == 100


def test_bytes_and_files_of_a_batch_are_limited_at_the_source():
    options = BufferOptions(max_files=3, max_bytes="1g").source_options()
    assert options == {"maxFilesPerTrigger": "3", "maxBytesPerTrigger": "1g"}


def test_grants_are_there_before_the_quads(spark, monkeypatch):
    store = SnapshotStore(spark, scratch_path(spark, "store"), grants=[("staff", "update")])

    def fail(*_):
        raise RuntimeError("the write of the quads fails")

    monkeypatch.setattr(SnapshotStore, "_write_rows", staticmethod(fail))
    with pytest.raises(RuntimeError):
        store.add(given(spark, ("urn:a", "1")))
    assert {(r["g"], r["role"]) for r in store.permissions().collect()} == {("urn:g", "staff")}
    assert store.read().count() == 0


# -- stored orders -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def ordered(spark):
    store = SnapshotStore(spark, scratch_path(spark, "store"), copies=("s", "o"))
    rows = [(f"urn:s{i}", f"urn:p{i % 3}", lit(f"v{i % 7}") if i % 2 else f"urn:o{i % 5}", f"urn:g{i % 2}") for i in range(60)]
    store.add(statements(spark, rows))
    return store, rows


def files_filter(df, key):
    plan = plan_of(df)
    digits = hashlib.md5(key.encode()).hexdigest()[:2]
    return re.search(rf"PartitionFilters: \[[^]]*\(ph#\d+ = {digits}\)", plan) is not None


@pytest.mark.parametrize(
    "slots", [{"o": "urn:o2"}, {"o": lit("v3")}, {"s": "urn:s8"}, {"p": "urn:p1"}, {"p": "urn:p1", "o": lit("v1")}, {"s": "urn:s9", "p": "urn:p0"}]
)
def test_stored_lookups_open_one_folder(ordered, slots):
    store, rows = ordered
    got = scan(store.quads(), **slots)
    key = slots.get("s") or slots.get("o") or slots.get("p")
    assert files_filter(got, key if isinstance(key, str) else key.value)
    want = scan(store.read(), **slots)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


def test_stored_patterns_filter_folders(ordered):
    store, _ = ordered
    assert files_filter(pattern(store.quads(), "?s", "urn:p2", "?o").df, "urn:p2")
    sol = bgp(store.quads(), [("?s", "urn:p0", "?o"), ("?s", "?p", lit("v3"))], graph="urn:g1")
    want = bgp(store.read(), [("?s", "urn:p0", "?o"), ("?s", "?p", lit("v3"))], graph="urn:g1")
    assert sorted(map(str, sol.df.collect())) == sorted(map(str, want.df.collect()))
    assert count_all(store.quads()).first()["n"] == 60 == frame(store.quads()).count()


def test_copies_are_checked(spark):
    with pytest.raises(ValueError):
        SnapshotStore(spark, "/nowhere", copies=("p",))


# -- the rule table ----------------------------------------------------------------------

RULES = [
    ("urn:sub", V.SUB_PROPERTY_OF, "urn:super"), ("urn:super", V.DOMAIN, "urn:C"), ("urn:super", V.RANGE, "urn:D"),
    ("urn:C", V.SUB_CLASS_OF, "urn:E"), ("urn:super", V.INVERSE_OF, "urn:back"), ("urn:E", V.EQUIVALENT_CLASS, "urn:F"),
    ("urn:back", V.EQUIVALENT_PROPERTY, "urn:retro"), ("urn:kind", V.SUB_PROPERTY_OF, V.RDF_TYPE),
]
FACTS = [("urn:x", "urn:sub", "urn:y"), ("urn:x", "urn:super", lit("text")), ("urn:z", "urn:kind", "urn:C"), ("urn:w", V.RDF_TYPE, "urn:F")]


def inferred(spark, **more):
    new = I.infer(statements(spark, RULES + FACTS), ["RDFS_PLUS"], **more)
    return {(r["s"], r["p"], r["o"]) for r in new.where(~F.col("p").isin(*I.DECLARING)).collect()}


def test_rules_are_fired_from_one_table(spark):
    classes = {("urn:x", c) for c in ("urn:C", "urn:E", "urn:F")} | {("urn:y", "urn:D"), ("urn:w", "urn:E")} | {("urn:z", c) for c in ("urn:C", "urn:E", "urn:F")}
    assert inferred(spark) == {(s, V.RDF_TYPE, c) for s, c in classes} | {
        ("urn:x", "urn:super", "urn:y"), ("urn:y", "urn:back", "urn:x"), ("urn:y", "urn:retro", "urn:x"),
    }


def test_many_rules_are_joined_by_shares(spark, monkeypatch):
    want = inferred(spark)
    monkeypatch.setattr(I, "SENT", 0)
    assert inferred(spark) == want


def test_facts_are_not_shuffled_by_predicate(spark):
    """The fact scan is expanded where it is: above it, only the exchange that makes the results distinct."""
    q = statements(spark, RULES).union(statements(spark, FACTS))
    known = q.select(*I.FACT)
    d = I.close_declarations(known, I.rules_of(["RDFS_PLUS"]))
    fired = plan_of(I._fired(known, d))
    assert "hashpartitioning" not in fired and "BroadcastHashJoin" in fired and "Generate inline" in fired
    assert d.sent and d.gives_type and not d.recursive


def test_groups_of_equivalent_names(spark):
    def links(*rows):
        return spark.createDataFrame(rows, "k string, a string, b string")

    def groups(df):
        return {(r["k"], r["name"]): r["rep"] for r in equivalence_groups(df, ("k",)).collect()}

    chain = [("x", f"n{i:03d}", f"n{i + 1:03d}") for i in range(200)]
    got = groups(links(*chain, ("y", "n005", "a"), ("y", "b", "n005"), ("y", "q", "q")))
    assert {v for (k, _), v in got.items() if k == "x"} == {"n000"} and len([k for k in got if k[0] == "x"]) == 201
    assert {n: v for (k, n), v in got.items() if k == "y"} == {"n005": "a", "a": "a", "b": "a"}
    star = [("x", "hub", f"s{i}") for i in range(50)]
    assert set(groups(links(*star)).values()) == {"hub"}
    assert groups(links(("x", "a", "a"))) == {}


def test_a_group_is_stored_once(spark):
    """k equivalent names: k rows in the rule table, and k * (k - 1) statements only in the result."""
    rows = [(f"urn:p{i:02d}", V.EQUIVALENT_PROPERTY, f"urn:p{i + 1:02d}") for i in range(29)]
    facts = statements(spark, rows + [("urn:a", "urn:p17", "urn:b")]).select(*I.FACT)
    d = I.close_declarations(facts, I.rules_of(["EQUIVALENT_PROPERTY"]))
    assert d.rules.count() == 30 and d.rules.where(F.size("outs") > 1).count() == 0 and d.members.count() == 1
    new = I.infer_with(facts, d)
    assert new.where("s = 'urn:a'").count() == 29
    assert new.where(F.col("p") == V.EQUIVALENT_PROPERTY).count() == 30 * 29 - 29


def test_new_queries_are_registered():
    assert {"search_index_words", "search_index_rare_first", "constrain_shared_quads", "infer_equivalent_chain", "stored_lookup_by_object"} <= set(QUERIES)

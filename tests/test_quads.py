"""Scans, graphs and updates on small sets of statements."""

import pytest
from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import statements
from quadloom.operators import scan as S
from quadloom.operators.patterns import bgp, pattern
from quadloom.operators.updates import Store, UnknownGraph, distinct_quads
from quadloom.sources.snapshots import SnapshotStore

C5, C6 = "urn:c5", "urn:c6"


def n(df):
    return df.first()["n"]


def yes(df):
    return df.first()["result"]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "store")


def four(k, g=None):
    return [(f"urn:s{k}{i}", "urn:p", lit(i), g) for i in range(4)]


def test_counts_by_graph(spark):
    q = statements(spark, four("a") + four("b", C5) + four("c", C6))
    assert n(S.count_in(q, [C5, None, C5])) == 8
    assert n(S.count_in(q, [C6, None, C5])) == 12
    assert n(S.count_in(q, [None])) == 4
    assert n(S.count_in(q, [])) == 4  # an empty list is the default graph
    assert n(S.count_in(q, ["urn:unknown"])) == 0
    assert n(S.count_all(q)) == 12
    with pytest.raises(ValueError):
        S.count_in(q, None)


def test_scan_contexts(spark):
    st = ("urn:s", "urn:p", "urn:o")
    two = [("urn:a", "urn:p", "urn:x"), ("urn:b", "urn:p", "urn:x")]
    q = statements(spark, [(*t, C5) for t in two] + [(*t, g) for t in [st, ("urn:t", "urn:p", "urn:o")] for g in (C5, C6)])
    assert S.scan(q).count() == 6
    assert S.scan(q, contexts=[C5, C6]).count() == 6
    assert S.scan(q, contexts=["urn:unknown", C6]).count() == 2
    d = statements(spark, [(*st, None)])
    assert S.scan(d).first()["g"] is None


def test_has_statement(spark):
    q = statements(spark, [("urn:alice", "urn:name", lit("Alice"), "urn:c1")])

    def has(*contexts):
        return yes(S.has_statement(q, "urn:alice", "urn:name", lit("Alice"), contexts))

    assert [has("urn:c1"), has("urn:c1", None), has(None), has()] == [True, True, False, True]
    assert yes(S.has_statement(q)) and not yes(S.is_empty(q))
    assert not yes(S.has_statement(q, o="Alice"))


def test_language_is_part_of_the_term(spark):
    q = statements(spark, [("urn:fei", "urn:last", lit("Ling", lang="zh"))])
    assert not yes(S.has_statement(q, o=lit("Ling", lang="en")))
    assert not yes(S.has_statement(q, o=lit("Ling")))
    assert yes(S.has_statement(q, o=lit("Ling", lang="zh")))


def test_blank_node_ids(spark):
    q = statements(spark, [("urn:s", "urn:p", "_:b1", "urn:c1")])
    assert yes(S.has_statement(q, o="_:b1", contexts=["urn:c1"]))
    assert not yes(S.has_statement(q, o="_:b2"))


def test_malformed_literals_are_kept_verbatim(spark):
    q = statements(spark, [("urn:s", "urn:p", lit("4.0", dt=V.XSD_INTEGER))])
    row = q.first()
    assert (row["o"], row["o_dt"], row["o_num"]) == ("4.0", V.XSD_INTEGER, 4.0)
    bad = statements(spark, [("urn:s", "urn:p", lit("four", dt=V.XSD_INTEGER))]).first()
    assert (bad["o"], bad["o_num"]) == ("four", None)


def test_graphs(spark):
    q = statements(spark, four("a") + four("b", C5))
    registered = spark.createDataFrame([("urn:empty",)], "g string")
    assert [r["g"] for r in S.list_graphs(q, registered).collect()] == [C5, "urn:empty", V.DEFAULT_GRAPH]


# -- updates -----------------------------------------------------------------------


def store(spark, rows):
    return Store(statements(spark, rows))


def test_add_is_idempotent(spark):
    rows = four("a") + four("b", C5)
    s = store(spark, rows).insert_data(rows).insert_data(rows)
    assert s.quads.count() == 8
    many = statements(spark, rows * 5)
    assert add_once(spark, many) == 8


def add_once(spark, df):
    return Store(df.limit(0)).add(df).add(df).quads.count()


def test_explicit_contexts_win(spark):
    s = Store(statements(spark, four("a")).limit(0))
    s = s.add(statements(spark, [("urn:s", "urn:p", "urn:o", "urn:own")]), [C5, None])
    assert sorted(r["g"] for r in s.quads.collect()) == [C5, V.DEFAULT_GRAPH]
    s = s.add(statements(spark, [("urn:s", "urn:p", "urn:o", "urn:own")]))
    assert n(S.count_in(s.quads, ["urn:own"])) == 1


def test_remove_from_contexts(spark):
    st = ("urn:s", "urn:p", "urn:o")
    s = store(spark, [(*st, "urn:c3"), (*st, "urn:c4")])
    one = statements(spark, [st])
    assert s.remove_statements(one, ["urn:c3", "urn:c4", "urn:c5"]).quads.count() == 0
    left = s.remove_statements(one, ["urn:c4", "urn:c5"]).quads.collect()
    assert [r["g"] for r in left] == ["urn:c3"]
    assert s.remove(*st).quads.count() == 0
    assert s.remove_statements(one, any_graph=True).quads.count() == 0
    assert s.remove_statements(one).quads.count() == 2  # its own graph is the default graph


def test_add_then_remove_gives_the_old_state(spark):
    s = store(spark, four("a"))
    extra = statements(spark, four("z", C6))
    assert s.add(extra).remove_statements(extra).quads.count() == 4
    assert s.add(extra).remove_statements(extra).add(extra).quads.count() == 8


def test_delete_data_matches_the_datatype(spark):
    s = store(spark, [("urn:s", "urn:p", lit(5))])
    assert s.delete_data([("urn:s", "urn:p", lit("5"))]).quads.count() == 1
    assert s.delete_data([("urn:s", "urn:p", lit(5), C5)]).quads.count() == 1
    assert s.delete_data([("urn:s", "urn:p", lit(5))]).quads.count() == 0


def test_clear(spark):
    s = store(spark, four("a") + four("b", "urn:c1") + four("c", "urn:c2") + [("urn:s", "urn:p", "urn:o", "urn:c3")])
    assert s.clear([None, "urn:c1"]).quads.count() == 5
    assert s.clear([]).quads.count() == 9
    assert s.clear().quads.count() == 0
    with pytest.raises(UnknownGraph):
        s.clear(["urn:unknown"])


def test_graph_management(spark):
    s = store(spark, [("urn:fei", "urn:p", lit(1)), ("urn:fei", "urn:p", lit(2))])
    s = s.copy_graph(None, "urn:a")
    assert n(S.count_in(s.quads, ["urn:a"])) == 2
    s = s.move_graph(None, "urn:b")
    assert (n(S.count_in(s.quads, ["urn:b"])), n(S.count_in(s.quads, [None]))) == (2, 0)
    s = s.drop_graph("urn:a").drop_graph("urn:b")
    assert s.quads.count() == 0
    with pytest.raises(UnknownGraph):
        s.drop_graph("urn:abc")
    s = s.create_graph("urn:new")
    assert s.graph_exists("urn:new") and s.quads.count() == 0
    with pytest.raises(ValueError):
        s.create_graph("urn:new")


def test_delete_insert_uses_the_old_state(spark):
    s = store(spark, [("urn:a", "urn:mail", lit("old")), ("urn:b", "urn:mail", lit("keep"))])
    where = pattern(s.quads, "urn:a", "urn:mail", "?m")
    s = s.modify(where, delete=[("urn:a", "urn:mail", "?m")], insert=[("urn:a", "urn:mail", lit("new")), ("urn:a", "urn:was", "?m")])
    got = {(r["s"], r["p"], r["o"]) for r in s.quads.collect()}
    assert got == {("urn:a", "urn:mail", "new"), ("urn:a", "urn:was", "old"), ("urn:b", "urn:mail", "keep")}


def test_constant_templates_with_an_unrelated_condition(spark):
    s = store(spark, [("urn:a", "urn:p", lit(1)), ("urn:b", "urn:p", lit(2))])
    where = bgp(s.quads, [("?x", "urn:p", "?y")])
    assert s.modify(where, insert=[("urn:flag", "urn:set", lit(True))]).quads.count() == 3
    none = bgp(s.quads, [("?x", "urn:none", "?y")])
    assert s.modify(none, insert=[("urn:flag", "urn:set", lit(True))]).quads.count() == 2


# -- versions ------------------------------------------------------------------------


def test_writes_and_removals(spark, folder):
    st = SnapshotStore(spark, folder)
    assert st.read().count() == 0 and st.registered().count() == 0
    st.add(statements(spark, four("a") + four("b", C5)))
    assert st.read().count() == 8
    st.add(statements(spark, four("a") + four("c", C6)))
    assert st.read().count() == 12
    st.clear([C5])
    st.remove_statements(statements(spark, [("urn:sa0", "urn:p", lit(0))]))
    st.add(statements(spark, [("urn:sb0", "urn:p", lit(0), C5)]))
    assert st.read().count() == 12 - 4 - 1 + 1
    st.add(statements(spark, [("urn:sa0", "urn:p", lit(0))]))
    assert st.read().count() == 9 and st.read(predicates=["urn:none"]).count() == 0
    fresh = SnapshotStore(spark, folder + "-fresh")
    fresh.write(adds=st.read())
    assert fresh.read().count() == 9
    assert "Exchange" not in fresh.read()._jdf.queryExecution().executedPlan().toString()
    st.replace(statements(spark, four("z")))
    assert st.read().count() == 4
    with pytest.raises(UnknownGraph):
        st.clear(["urn:unknown"])
    st.clear()
    assert st.read().count() == 0


def test_one_write_removes_before_it_adds(spark, folder):
    st = SnapshotStore(spark, folder)
    quad = statements(spark, [("urn:s", "urn:p", lit(0))])
    st.write(adds=quad, dels=quad)
    assert st.read().count() == 1
    st.write(dels=quad)
    assert st.read().count() == 0


def test_interleaved_writers_lose_nothing(spark, folder):
    one, two = SnapshotStore(spark, folder), SnapshotStore(spark, folder)
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:
        jobs = [
            pool.submit(st.add, statements(spark, [(f"urn:{name}{i}", "urn:p", lit(0)), ("urn:both", "urn:p", lit(0))]))
            for i in range(3) for name, st in (("a", one), ("b", two))
        ]
        [j.result() for j in jobs]
    assert one.read().count() == two.read().count() == 7


def test_graphs_and_long_predicates(spark, folder):
    st = SnapshotStore(spark, folder)
    long = "urn:" + "p/" * 300
    st.add(statements(spark, [("urn:s", long, lit(1), C5), ("urn:t", "urn:p", lit(1), C5), ("urn:t", "urn:p", lit(2), C6)]))
    assert st.read(predicates=[long]).count() == 1
    st.create_graph("urn:empty")
    assert [r["g"] for r in st.registered().collect()] == ["urn:empty"]
    st.copy_graph(C5, "urn:empty")
    assert st.read().where(F.col("g") == "urn:empty").count() == 2
    st.move_graph(C6, C5)
    assert {(r["g"], r["s"]) for r in st.read().where("g <> 'urn:empty'").collect()} == {(C5, "urn:t")}
    st.add_graph(C5, "urn:empty")
    assert st.read().count() == 4
    st.drop_graph("urn:empty")
    assert st.read().count() == 1 and st.registered().count() == 0
    with pytest.raises(UnknownGraph):
        st.copy_graph("urn:empty", C5)
    st.copy_graph(C5, C5)
    where = bgp(st.read(), [("?s", "urn:p", "?o")])
    st.modify(where, delete=[("?s", "urn:p", "?o")], insert=[("?s", "urn:q", "?o")], graph=C5)
    assert [r["p"] for r in st.read().collect()] == ["urn:q"]


def test_volume(spark):
    rows = spark.range(100_000).select(
        F.lit("urn:g").alias("g"), F.concat(F.lit("urn:s"), F.col("id").cast("string")).alias("s"),
        F.lit("urn:p").alias("p"), F.lit("urn:o").alias("o"), F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"),
        F.lit(None).cast("double").alias("o_num"), F.lit(None).cast("timestamp_ntz").alias("o_ts"),
        F.lit(None).cast("string").alias("doc_id"),
    )
    assert distinct_quads(rows.union(rows)).count() == 100_000
    assert Store(rows).add(rows).quads.count() == 100_000

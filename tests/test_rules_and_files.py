"""Inference, readers, writers, documents, permissions, streams."""

import pytest
from pyspark.sql import functions as F

from quadloom import iri, lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import statements
from quadloom.functions.quad_columns import with_values
from quadloom.operators import constraints as C
from quadloom.operators import forms
from quadloom.operators import inference as I
from quadloom.operators import permissions as P
from quadloom.operators.patterns import bgp, pattern
from quadloom.operators.scan import has_statement
from quadloom.session import scratch_path, shared_folder
from quadloom.sources import readers, sinks
from quadloom.sources.snapshots import SnapshotStore, stream_batch
from quadloom.streaming.buffered import DELETE, INSERT, Buffer, BufferOptions, change_stream, insert_stream

G1, G = "urn:dirgraph1", "urn:dirgraph"
A = "urn:ad:"


def triples(df):
    return {(r["s"], r["p"], r["o"]) for r in df.collect()}


def people(g):
    return [
        ("urn:micah", A + "lname", lit("Dubinko"), g), ("urn:micah", A + "fname", lit("Micah"), g),
        ("urn:micah", A + "developPrototypeOf", "urn:Semantics", g), ("urn:micah", V.RDF_TYPE, A + "SeniorEngineer", g),
        ("urn:micah", A + "worksFor", "urn:co", g),
        ("urn:john", A + "fname", lit("John"), g), ("urn:john", A + "lname", lit("Snelson"), g),
        ("urn:john", A + "writeFuncSpecOf", "urn:Inference", g), ("urn:john", V.RDF_TYPE, A + "LeadEngineer", g),
        ("urn:john", A + "worksFor", "urn:co", g),
    ]


@pytest.fixture(scope="module")
def equivalent(spark):
    rules = [(A + "writeFuncSpecOf", "design"), (A + "developPrototypeOf", "design"), (A + "design", "develop")]
    return statements(spark, people(G1) + [(a, V.EQUIVALENT_PROPERTY, A + b, G1) for a, b in rules]).cache()


def test_equivalent_property(equivalent):
    new = triples(I.infer(equivalent, ["EQUIVALENT_PROPERTY"]))
    data = {t for t in new if not t[1].startswith(V.OWL)}
    assert data == {
        *[("urn:john", A + p, "urn:Inference") for p in ("design", "develop", "developPrototypeOf")],
        *[("urn:micah", A + p, "urn:Semantics") for p in ("design", "develop", "writeFuncSpecOf")],
    }
    turned = {(A + "design", A + "writeFuncSpecOf"), (A + "design", A + "developPrototypeOf"), (A + "develop", A + "design")}
    assert turned <= {(s, o) for s, p, o in new if p == V.EQUIVALENT_PROPERTY}
    # symmetric and transitive over four properties: 12 pairs, 3 of them stated
    assert len(new - data) == 9


def test_inference_switch_and_scope(equivalent):
    def seen(contexts=(), **kw):
        q = I.with_inferred(equivalent, ["EQUIVALENT_PROPERTY", None], **kw)
        return has_statement(q, "urn:john", A + "design", "urn:Inference", contexts).first()["result"]

    assert [seen([G1]), seen(), seen([G])] == [True, True, False]
    assert not seen(include_inferred=False)
    assert I.infer(equivalent, []).count() == 0
    assert has_statement(
        I.with_inferred(equivalent, [], defaults=["EQUIVALENT_PROPERTY"]), "urn:john", A + "design"
    ).first()["result"]
    with pytest.raises(ValueError):
        I.rules_of(["NO_SUCH_RULES"])


def test_rdfs(spark):
    rules = [
        (A + "writeFuncSpecOf", V.SUB_PROPERTY_OF, A + "design", G), (A + "developPrototypeOf", V.SUB_PROPERTY_OF, A + "design", G),
        (A + "design", V.SUB_PROPERTY_OF, A + "develop", G), (A + "LeadEngineer", V.SUB_CLASS_OF, A + "Engineer", G),
        (A + "SeniorEngineer", V.SUB_CLASS_OF, A + "Engineer", G), (A + "Engineer", V.SUB_CLASS_OF, A + "Employee", G),
    ]
    new = triples(I.infer(statements(spark, people(G1) + rules), ["RDFS"]))
    john = {t for t in new if t[0] == "urn:john"}
    assert john == {
        ("urn:john", A + "design", "urn:Inference"), ("urn:john", A + "develop", "urn:Inference"),
        ("urn:john", V.RDF_TYPE, A + "Engineer"), ("urn:john", V.RDF_TYPE, A + "Employee"),
    }
    assert len({t for t in new if t[0] == "urn:micah"}) == 4
    assert sum(p == V.SUB_PROPERTY_OF for _, p, _ in new) == 2
    assert sum(p == V.SUB_CLASS_OF for _, p, _ in new) == 2
    # rules and facts in different graphs do not meet when graphs are kept apart
    apart = I.infer(statements(spark, people(G1) + rules), ["RDFS"], per_graph=True)
    assert {r["g"] for r in apart.collect()} == {G}


def test_rules_feed_each_other(spark):
    q = statements(
        spark,
        [
            ("urn:R", V.ON_PROPERTY, "urn:colour"), ("urn:R", V.HAS_VALUE, lit("red")),
            ("urn:R", V.SUB_CLASS_OF, "urn:Bright"), ("urn:S", V.ON_PROPERTY, "urn:child"),
            ("urn:S", V.ALL_VALUES_FROM, "urn:R"), ("urn:Bright", V.SUB_CLASS_OF, "urn:S"),
            ("urn:parent", V.INVERSE_OF, "urn:child"), ("urn:tint", V.SUB_PROPERTY_OF, "urn:colour"),
            ("urn:child", V.DOMAIN, "urn:Parent"),
            ("urn:a", "urn:tint", lit("red")), ("urn:b", "urn:parent", "urn:a"), ("urn:c", "urn:parent", "urn:b"),
            ("urn:d", "urn:tint", lit("blue")),
        ],
    )
    new = triples(I.infer(q, ["RDFS_PLUS_FULL"]))
    for x in ("urn:a", "urn:b", "urn:c"):  # red passes from parent to child
        assert {(x, V.RDF_TYPE, c) for c in ("urn:R", "urn:Bright", "urn:S")} <= new
        assert (x, "urn:colour", "red") in new
    assert {("urn:a", V.RDF_TYPE, "urn:Parent"), ("urn:b", V.RDF_TYPE, "urn:Parent")} <= new
    assert ("urn:d", "urn:colour", "blue") in new and not any(s == "urn:d" and p == V.RDF_TYPE for s, p, _ in new)
    # a fixpoint: nothing follows from the result any more
    again = q.select(*I.FACT).union(I.infer(q, ["RDFS_PLUS_FULL"])).withColumn("g", F.lit("urn:all"))
    assert I.infer(again, ["RDFS_PLUS_FULL"]).count() == 0


# -- files -----------------------------------------------------------------------------


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_nquads(spark, tmp_path):
    path = write(tmp_path, "a.nq", "\n".join([
        "# a comment", "",
        '<urn:s> <urn:p> "plain" .',
        '<urn:s> <urn:p> "say \\"hi\\"\\n\\u0041"@EN-gb <urn:g> . # end',
        '_:b1 <urn:p> _:b2 <urn:g> .',
        '<urn:s><urn:p><urn:o><urn:g>.',
        '<urn:s> <urn:p> "5"^^<http://www.w3.org/2001/XMLSchema#integer> <urn:g> .',
    ]))
    got = readers.load(spark, path, "N-Quads", contexts=["urn:ignored"]).collect()
    assert len(got) == 5 and {r["g"] for r in got} == {V.DEFAULT_GRAPH, "urn:g"}
    by_object = {r["o"]: r for r in got}
    assert by_object['say "hi"\nA']["o_lang"] == "en-gb"
    assert by_object["plain"]["o_dt"] == V.XSD_STRING and by_object["5"]["o_num"] == 5.0
    blank = [r for r in got if r["s"].startswith(V.BLANK_PREFIX)]
    assert len(blank) == 1 and blank[0]["o"].startswith(V.BLANK_PREFIX)
    # labels are local to a file
    other = write(tmp_path, "b.nq", "_:b1 <urn:p> <urn:o> .")
    subjects = {r["s"] for r in readers.load(spark, [path, other], "nquads").where("s like 'urn:x-blank:%'").collect()}
    assert len(subjects) == 2


def test_ntriples_targets_and_base(spark, tmp_path):
    path = write(tmp_path, "a.nt", "<#me> <urn:p> <other> .\n")
    got = readers.load(spark, path, "ntriples", base="http://x.org/dir/doc", contexts=["urn:a", None])
    assert triples(got) == {("http://x.org/dir/doc#me", "urn:p", "http://x.org/dir/other")}
    assert {r["g"] for r in got.collect()} == {"urn:a", V.DEFAULT_GRAPH}


def test_malformed_input(spark, tmp_path):
    path = write(tmp_path, "bad.nt", "\n".join([
        '<urn:s> <urn:p> "4.0"^^<http://www.w3.org/2001/XMLSchema#integer> .',
        '<urn:s> <urn:p> "x"@en_foobar .',
        '<urn:s> <urn:p> "2020-99-01T00:00:00"^^<http://www.w3.org/2001/XMLSchema#dateTime> .',
        "not a statement", "<urn:s> <urn:p> <urn:o> <urn:g> .", "<urn:s> <urn:p> <urn:o> .",
    ]))
    with pytest.raises(Exception, match="malformed"):
        readers.load(spark, path, "ntriples").collect()
    assert readers.load(spark, path, "ntriples", mode=readers.DROP).count() == 1
    problems = [r["problem"] for r in readers.malformed(spark, path, "ntriples").collect()]
    assert sorted(problems) == ["malformed line"] + ["malformed literal"] * 3 + ["unexpected graph"]
    for fmt in ("trix", "binary", "jsonld"):
        with pytest.raises(readers.UnsupportedFormat):
            readers.load(spark, path, fmt)


def test_rdfjson(spark, tmp_path):
    path = write(tmp_path, "a.json", """{ "urn:s": { "urn:p": [
        {"value": "urn:o", "type": "uri"}, {"value": "Hi", "type": "literal", "lang": "en"},
        {"value": "7", "type": "literal", "datatype": "http://www.w3.org/2001/XMLSchema#int"} ] },
        "_:x": { "urn:q": [ {"value": "_:x", "type": "bnode"} ] } }""")
    got = readers.load(spark, path, "rdfjson")
    assert got.count() == 4
    x = got.where("p = 'urn:q'").first()
    assert x["s"] == x["o"] and x["s"].startswith(V.BLANK_PREFIX)
    bad = write(tmp_path, "bad.json", "{ not json")
    with pytest.raises(Exception, match="malformed document"):
        readers.load(spark, bad, "rdfjson").collect()


def test_long_literals_and_round_trip(spark, tmp_path):
    text = ("word \\ \"q\" \n" * 30_000) + "end"
    q = statements(spark, [("urn:s", "urn:p", lit(text), "urn:g"), ("urn:s", "urn:p", lit(1.5)), ("urn:s", "urn:p", lit("x", lang="de"))])
    path = str(tmp_path / "out")
    sinks.write_nquads(q, path)
    back = readers.load(spark, path, "nquads")
    assert back.select("g", "s", "p", "o", "o_kind", "o_dt", "o_lang", "o_num").exceptAll(
        q.select("g", "s", "p", "o", "o_kind", "o_dt", "o_lang", "o_num")).count() == 0
    assert back.count() == 3
    sinks.write_nquads(q.limit(0), str(tmp_path / "none"))
    assert readers.load(spark, str(tmp_path / "none"), "nquads").count() == 0


def test_result_writers(spark, tmp_path):
    q = statements(spark, [("urn:s", "urn:p", lit('a<b>&"', lang="en")), ("urn:t", "urn:p", lit(2)), ("urn:u", "urn:p", "urn:o")])
    sol = pattern(q, "?s", "urn:p", "?o")
    xml = sorted(r["value"] for r in sinks.xml_bindings(sol, ["o"]).collect())
    assert xml == [
        '<result><binding name="o"><literal datatype="http://www.w3.org/2001/XMLSchema#integer">2</literal></binding></result>',
        '<result><binding name="o"><literal xml:lang="en">a&lt;b&gt;&amp;&quot;</literal></binding></result>',
        '<result><binding name="o"><uri>urn:o</uri></binding></result>',
    ]
    sinks.write_json_bindings(sol, str(tmp_path / "j"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert '{"s":{"type":"uri","value":"urn:u"},"o":{"type":"uri","value":"urn:o"}}' in lines
    sinks.write_tsv(sol, str(tmp_path / "t"))
    assert "<urn:s>\t\"a<b>&\\\"\"@en" in [r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()]


# -- documents --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus(spark):
    def xml(title, s, value):
        return (f'<doc><title>{title}</title><sem:triples xmlns:sem="urn:x-sem"><sem:triple><sem:subject>{s}</sem:subject>'
                f'<sem:predicate>urn:p3</sem:predicate><sem:object datatype="{V.XSD_INT}">{value}</sem:object>'
                "</sem:triple></sem:triples></doc>")

    docs = spark.createDataFrame(
        [
            ("/directory1/doc1.xml", "First Title", 1, ["one"], xml("First Title", "urn:r9928", 1)),
            ("/directory2/doc2.xml", "Second Title", 5, ["two"], xml("Second Title", "urn:r9929", 2)),
        ],
        "doc_id string, text string, popularity int, collections array<string>, xml string",
    ).withColumn("uri", F.col("doc_id"))
    return docs, readers.extract_embedded(docs)


def test_embedded_triples(corpus):
    _, q = corpus
    assert triples(q) == {("urn:r9928", "urn:p3", "1"), ("urn:r9929", "urn:p3", "2")}
    assert {(r["s"], r["doc_id"]) for r in q.collect()} == {
        ("urn:r9928", "/directory1/doc1.xml"), ("urn:r9929", "/directory2/doc2.xml")}


BUCKETS = {"high": (5, None), "medium": (3, 5), "low": (1, 3)}


@pytest.mark.parametrize(
    "condition, first, second",
    [
        (lambda: C.text_search("First Title"), True, False), (lambda: C.text_search("Second Title"), False, True),
        (lambda: C.term_query("Second"), False, True), (lambda: C.text_search("First"), True, False), (lambda: C.text_search("irst"), False, False),
        (lambda: C.in_bucket("popularity", BUCKETS, "high"), False, True), (lambda: C.in_bucket("popularity", BUCKETS, "low"), True, False),
        (lambda: C.text_search("*"), True, True), (lambda: None, True, True), (lambda: C.in_directory("/directory1"), True, False),
        (lambda: C.in_directory("/directory"), False, False), (lambda: C.in_collections(["two", "three"]), False, True),
    ],
)
def test_constraints(spark, corpus, condition, first, second):
    docs, q = corpus
    seen = C.constrain(q, docs, condition())
    got = [forms.ask(bgp(seen, [("urn:" + r, "urn:p3", "?x")])).first()["result"] for r in ("r9928", "r9929")]
    assert got == [first, second]


# -- permissions ------------------------------------------------------------------------


def test_permissions(spark):
    q = statements(spark, [("urn:s", "urn:p", "urn:o", g) for g in ("urn:a", "urn:b", None)])
    perms = P.permissions(spark, [("urn:a", "r1", "READ"), ("urn:b", "r2", "read"), ("urn:b", "r1", "UPDATE")])
    assert [r["g"] for r in P.visible(q, perms, ["r1"]).collect()] == ["urn:a"]
    assert P.visible(q, P.permissions(spark), ["r1"]).count() == 0
    change = q.where("g = 'urn:b'")
    P.check_write(change, perms, ["r1"])
    with pytest.raises(PermissionError):
        P.check_write(change, perms, ["r2"])
    more = P.grant(perms, change, [("r2", "update")])
    P.check_write(change, more, ["r2"])
    assert P.grant(perms, change, []).count() == 3
    with pytest.raises(ValueError):
        P.permissions(spark, [("urn:a", "r1", "OWN")])


# -- streams ----------------------------------------------------------------------------


def test_insert_stream_is_idempotent(spark, tmp_path):
    source, store = tmp_path / "in", SnapshotStore(spark, str(tmp_path / "store"))
    q = statements(spark, [("urn:s", "urn:p", lit(i % 5)) for i in range(20)])
    q.repartition(3).write.parquet(str(source))
    stream = spark.readStream.schema(q.schema).options(**BufferOptions(max_files=1).source_options()).parquet(str(source))
    for attempt in ("one", "two"):
        insert_stream(stream, store, str(tmp_path / attempt)).awaitTermination()
        assert store.read().count() == 5
    # a batch that is delivered again replaces its folder
    assert store.add(q.limit(0), batch=stream_batch(str(tmp_path / "two"), 0)) and store.read().count() == 5
    more = statements(spark, [("urn:t", "urn:p", lit(1))])
    more.write.parquet(str(tmp_path / "more"))
    other = spark.readStream.schema(q.schema).parquet(str(tmp_path / "more"))
    insert_stream(other, store, str(tmp_path / "three")).awaitTermination()
    assert store.read().count() == 6


def test_change_stream_applies_the_last_operation(spark, tmp_path):
    def feed(name, ops):
        rows = [("urn:g", "urn:s", "urn:p", o, "lit", V.XSD_STRING, None, None, op, seq) for o, op, seq in ops]
        schema = "g string, s string, p string, o string, o_kind string, o_dt string, o_lang string, doc_id string, op string, seq long"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return schema

    store, options = SnapshotStore(spark, str(tmp_path / "store")), BufferOptions()
    schema = feed("a", [("x", INSERT, 1), ("y", INSERT, 2), ("x", DELETE, 3), ("z", DELETE, 4), ("z", INSERT, 5)])
    run = lambda: change_stream(
        spark.readStream.schema(schema).parquet(str(tmp_path / "in")), store, str(tmp_path / "cp"), options)
    run().awaitTermination()
    assert {r["o"] for r in store.read().collect()} == {"y", "z"}
    feed("b", [("y", DELETE, 6), ("x", INSERT, 7)])
    run().awaitTermination()
    assert {r["o"] for r in store.read().collect()} == {"x", "z"}
    # late operations of lower order change nothing, and an insert wins a tie
    feed("c", [("x", DELETE, 5), ("z", DELETE, 5)])
    run().awaitTermination()
    assert {r["o"] for r in store.read().collect()} == {"x", "z"}


def test_flush_on_demand(spark, tmp_path):
    q = statements(spark, [("urn:s", "urn:p", lit(1))])
    q.write.parquet(str(tmp_path / "in"))
    store = SnapshotStore(spark, str(tmp_path / "store"))
    stream = spark.readStream.schema(q.schema).parquet(str(tmp_path / "in"))
    buffer = Buffer(
        lambda options: insert_stream(stream, store, str(tmp_path / "cp"), options), BufferOptions(interval="1 hour")
    )
    try:
        buffer.flush()
        assert store.read().count() == 1
    finally:
        buffer.stop()


def test_shared_folder_is_the_sessions(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark) + "/")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert with_values(statements(spark, [("urn:s", "urn:p", iri("urn:o"))])).count() == 1

"""Exact numbers, relative IRIs, declarations given by rules, seeds of paths."""

import pytest
from pyspark.sql import functions as F

from quadloom import iri, lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import statements
from quadloom.functions.terms import exact_less, exact_parts, resolve_iri
from quadloom.model import with_base
from quadloom.operators import aggregates as A
from quadloom.operators import inference as I
from quadloom.operators import paths
from quadloom.operators.forms import construct, describe
from quadloom.operators.permissions import permissions
from quadloom.operators.patterns import bgp, equals, less_than, pattern
from quadloom.operators.updates import Store
from quadloom.sources.snapshots import SnapshotStore

REFS = ["g:h", "g", "./g", "g/", "/g", "g?y", "#s", "g#s", ";x", "", "..", "../", "../g", "../..", "../../g", "g/../h", "//h/x"]


@pytest.mark.parametrize("base", ["http://a/b/c/d;p?q", "http://example.org/app/now#x", "urn:p:x", "http://h", "tag:a/b/c"])
def test_constants_resolve_as_columns_do(spark, base):
    df = spark.createDataFrame([(r,) for r in REFS], "r string")
    found = [r.o for r in df.select(resolve_iri("r", base).alias("o")).collect()]
    assert [with_base(iri(r), base).value for r in REFS] == found


def test_base_leaves_variables_literals_and_null_alone():
    assert with_base("?x", "http://a/") == "?x"
    assert with_base(lit("x"), "http://a/") == lit("x")
    assert with_base(None, "http://a/") is None
    assert with_base("x", None) == "x"
    with pytest.raises(ValueError):
        with_base("x", "relative")


def test_relative_iris_in_every_form(spark):
    base = "http://example.org/x/"
    q = Store(statements(spark, [])).insert_data([("a", "p", "b"), ("b", "p", "c"), ("b", "q", "z")], base=base).quads
    sol = bgp(q, [("?s", paths.seq("p", "q"), "z")], base=base)
    assert [r.s for r in sol.select("s").collect()] == [base + "a"]
    assert bgp(q, [("?s", "p", "?o")], bindings={"o": "c"}, base=base).df.count() == 1
    assert construct(pattern(q, "?s", "q", "?o", base=base), [("?s", "../r", "?o")], base).first().p == "http://example.org/r"
    assert describe(q, "b", base=base).count() == 2
    assert Store(q).delete_data([("a", "p", "b")], base=base).quads.count() == 2
    where = pattern(q, "?s", "q", "?o", base=base)
    changed = Store(q).modify(where, delete=[("?s", "q", "?o")], insert=[("?s", "n", "?o")], base=base).quads
    assert {r.p for r in changed.collect()} == {base + "p", base + "n"}


NUMBERS = ["0", "-0", "+5", "5", "-5", "9007199254740993", "9007199254740992", "1" + "0" * 50, "-1" + "0" * 50, "12", "7"]


def test_exact_order_of_integers_of_any_length(spark):
    df = spark.createDataFrame([(x,) for x in NUMBERS], "o string")
    parts = df.select("o", exact_parts("o", F.lit(V.XSD_INTEGER)).alias("n"))
    a, b = parts.alias("a"), parts.alias("b")
    rows = a.join(b, F.lit(True)).select("a.o", F.col("b.o").alias("o2"), exact_less(F.col("a.n"), F.col("b.n")).alias("less"),
                                         (F.col("a.n") == F.col("b.n")).alias("same"))
    for r in rows.collect():
        assert (r.less, r.same) == (int(r.o) < int(r.o2), int(r.o) == int(r.o2)), (r.o, r.o2)


def test_decimals_and_floats(spark):
    forms = [("0.10", V.XSD_DECIMAL), ("0.1000000000000000000001", V.XSD_DECIMAL), ("1e-1", V.XSD_DOUBLE), ("-.5", V.XSD_DECIMAL)]
    q = statements(spark, [(f"urn:{i}", "urn:v", lit(o, dt)) for i, (o, dt) in enumerate(forms)])
    sol = pattern(q, "?s", "urn:v", "?n")

    def found(condition):
        return {r.s for r in sol.filter(condition).select("s").collect()}

    assert found(equals("n", lit("0.1", V.XSD_DECIMAL))) == {"urn:0", "urn:2"}
    assert found(less_than("n", lit("0.10000000000000000000001", V.XSD_DECIMAL))) == {"urn:0", "urn:3"}
    assert found(equals("n", 0.1)) == {"urn:0", "urn:1", "urn:2"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_typed_sums(spark, ansi):
    groups = {
        "ints": ([lit(2**53), lit(1), lit("01", V.XSD_INTEGER)], (str(2**53 + 2), V.XSD_INTEGER)),
        "small": ([lit("0.0000000001", V.XSD_DECIMAL), lit("-0.0", V.XSD_DECIMAL)], ("0.0000000001", V.XSD_DECIMAL)),
        "mixed": ([lit("100.5", V.XSD_DECIMAL), lit("0.50", V.XSD_DECIMAL), lit(-1)], ("100", V.XSD_DECIMAL)),
        "float": ([lit(1.5), lit(1)], ("2.5", V.XSD_DOUBLE)),
        "text": ([lit("x"), lit(1)], None),
        "long": ([lit("9" * 38), lit(1)], None),
    }
    rows = [(f"urn:{g}", "urn:v", o) for g, (values, _) in groups.items() for o in values]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = A.group(pattern(statements(spark, rows), "?g", "urn:v", "?n", merge=False), ["g"], t=A.sum_term("n")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert {r.g[4:]: r.t and tuple(r.t) for r in found} == {g: want for g, (_, want) in groups.items()}


def test_least_and_greatest_terms(spark):
    values = [lit(2**53 + 1), lit(2**53), lit("9.5", V.XSD_DECIMAL), lit("x")]
    sol = pattern(statements(spark, [(f"urn:{i}", "urn:v", o) for i, o in enumerate(values)]), "?s", "urn:v", "?n")
    row = A.group(sol, least=A.min_term("n"), most=A.max_term("n"), some=A.sample_term(sol, "n")).first()
    assert (row.least.o, row.least.o_dt) == ("9.5", V.XSD_DECIMAL)
    assert (row.most.o, row.most.o_dt) == (str(2**53 + 1), V.XSD_INTEGER)
    assert (row.some.o, row.some.o_dt) == ("9.5", V.XSD_DECIMAL)  # the least form


def test_least_and_greatest_terms_of_any_length(spark):
    long = 10**24
    groups = {
        "negative": ([-long - 1, -long - 2, -long], -long - 2, -long),
        "huge": ([-(10**400) - 1, -(10**400), 10**400 + 1, 10**400], -(10**400) - 1, 10**400 + 1),
        "zeros": ([f"000{long + 2}", long + 3, f"0{long + 1}"], f"0{long + 1}", long + 3),
        "places": (["-0.1234567890123456789", "-0.12345678901234567891", "-0.123456789012345678"], "-0.12345678901234567891", "-0.123456789012345678"),
    }
    term = lambda x: lit(str(x), V.XSD_DECIMAL if "." in str(x) else V.XSD_INTEGER)
    data = [(f"urn:{g}", "urn:v", term(x)) for g, (xs, _, _) in groups.items() for x in xs]
    sol = pattern(statements(spark, data), "?g", "urn:v", "?n")
    found = A.group(sol, ["g"], least=A.min_term("n"), most=A.max_term("n")).collect()
    assert {r.g[4:]: (r.least.o, r.most.o) for r in found} == {g: (str(a), str(b)) for g, (_, a, b) in groups.items()}


def test_declarations_given_by_rules(spark):
    facts = statements(spark, [
        ("urn:kindOf", V.SUB_PROPERTY_OF, V.SUB_CLASS_OF), ("urn:Cat", "urn:kindOf", "urn:Animal"),
        ("urn:Animal", "urn:kindOf", "urn:Being"), ("urn:tom", V.RDF_TYPE, "urn:Cat"),
    ])
    new = I.infer(facts, ["RDFS"])
    types = [r.o for r in new.where((F.col("p") == V.RDF_TYPE) & (F.col("s") == "urn:tom")).collect()]
    assert sorted(types) == ["urn:Animal", "urn:Being"]
    assert new.count() == new.dropDuplicates(["s", "p", "o"]).count()


def test_declarations_as_data(spark):
    facts = statements(spark, [
        (V.SUB_CLASS_OF, V.SUB_PROPERTY_OF, "urn:related"), ("urn:A", V.SUB_CLASS_OF, "urn:B"), ("urn:B", V.SUB_CLASS_OF, "urn:C"),
    ])
    new = I.infer(facts, ["RDFS"])
    pairs = {(r.s, r.o) for r in new.where(F.col("p") == "urn:related").collect()}
    assert pairs == {("urn:A", "urn:B"), ("urn:B", "urn:C"), ("urn:A", "urn:C")}


def test_names_of_predicates_stay_bounded(spark):
    rows = [(f"urn:p{i}", V.SUB_PROPERTY_OF, "urn:top") for i in range(1500)]
    facts = statements(spark, [*rows, ("urn:a", "urn:p7", "urn:b"), ("urn:a", "urn:other", "urn:b")])
    facts = facts.select(*I.FACT)
    d = I.close_declarations(facts, I.rules_of(["RDFS"]))
    assert not d.recursive and not d.again and len(d.sources) <= I.SHARES
    found = I.infer_with(facts, d).where(F.col("s") == "urn:a").collect()
    assert [(r.p, r.o) for r in found] == [("urn:top", "urn:b")]


@pytest.mark.parametrize("path", [paths.plus("urn:n"), paths.star("urn:n"), paths.seq(paths.plus("urn:n"), "urn:n"), paths.plus(paths.seq("urn:n", "urn:n"))])
def test_seeded_paths_give_the_same(spark, path):
    rows = [(f"urn:{i}", "urn:n", f"urn:{(i + 1) % 9}") for i in range(9)] + [("urn:20", "urn:n", "urn:21"), ("urn:21", "urn:n", "urn:22")]
    rows += [("urn:20", "urn:start", lit(1)), ("urn:3", "urn:start", lit(1))]
    q = statements(spark, rows)
    seeded = bgp(q, [("?x", path, "?y"), ("?x", "urn:start", lit(1))])
    plain = pattern(q, "?x", path, "?y").join(pattern(q, "?x", "urn:start", lit(1)))
    found = sorted(map(tuple, seeded.select("x", "y").collect()))
    assert found == sorted(map(tuple, plain.select("x", "y").collect())) and found


def test_writes_need_permission(spark, tmp_path):
    path = str(tmp_path / "store")
    one = statements(spark, [("urn:a", "urn:p", "urn:b", "urn:one")])
    two = statements(spark, [("urn:a", "urn:p", "urn:c", "urn:two")])
    owner = SnapshotStore(spark, path, roles=["owner"], grants=[("owner", "read"), ("owner", "update")])
    assert owner.permissions().count() == 0
    owner.add(one)
    guest = SnapshotStore(spark, path, roles=["guest"])
    for write in (
        lambda: guest.add(one.union(two)), lambda: guest.remove(s="urn:a"), lambda: guest.clear(["urn:one"]),
        lambda: guest.drop_graph("urn:one"), lambda: guest.move_graph("urn:one", "urn:two"),
        lambda: guest.modify(pattern(guest.read(), "?s", "urn:p", "?o"), insert=[("?s", "urn:q", "?o")], graph="urn:one"),
    ):
        with pytest.raises(PermissionError):
            write()
    assert owner.read().count() == 1 and guest.visible().count() == 0
    guest.add(two)  # a graph without permissions is free
    owner.grant(permissions(spark, [("urn:one", "guest", "read"), ("urn:one", "guest", "update")]))
    guest.remove(s="urn:a", contexts=["urn:one"])
    assert [r.g for r in owner.read().collect()] == ["urn:two"]
    assert {tuple(r) for r in owner.permissions().where("role = 'owner'").collect()} == {
        ("urn:one", "owner", "READ"), ("urn:one", "owner", "UPDATE")
    }

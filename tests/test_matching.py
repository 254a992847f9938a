"""Patterns, joins, paths, forms on the address book and other small data."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import statements
from quadloom.operators import aggregates as A
from quadloom.operators import forms
from quadloom.operators import paths
from quadloom.operators.closure import reachable, transitive_closure
from quadloom.operators.patterns import bgp, equals, not_equals, num, pattern, values, var
from quadloom.operators.solutions import Solutions

ID, AD, G = "urn:id:", "urn:ad:", "urn:dirgraph"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is not None, x) if x is not None else (False, "") for x in t])


@pytest.fixture(scope="module")
def book(spark):
    people = {
        "1111": ("John", "Snelson", 111111111.0, "john.snelson@x"),
        "2222": ("Micah", "Dubinko", 22222222.0, None),
        "3333": ("Fei", "Ling", None, "fei.ling@x"),
    }
    out = []
    for k, (first, last, tel, mail) in people.items():
        for p, v in (("firstName", first), ("lastName", last), ("homeTel", tel), ("email", mail)):
            if v is not None:
                out.append((ID + k, AD + p, lit(v), G))
    return statements(spark, out).cache()


def test_optional_and_filter(book):
    sol = bgp(book, [("?person", AD + "firstName", "?first")], graph=G)
    sol = sol.optional(pattern(book, "?person", AD + "homeTel", "?phone", graph=G)).filter(equals("first", lit("Fei")))
    assert rows(sol.select("person", "phone")) == [(ID + "3333", None)]


def test_exists_in_order(book):
    sol = bgp(book, [("?person", AD + "lastName", "?last")], graph=G)
    sol = sol.exists(pattern(book, "?person", AD + "homeTel", "?t", graph=G))
    got = [tuple(r) for r in forms.order_by(sol, "last").select("person", "last").collect()]
    assert got == [(ID + "2222", "Dubinko"), (ID + "1111", "Snelson")]


def test_from_named_with_exists(book):
    sol = bgp(book, [("?person", AD + "lastName", "?name")], graph="?g", from_named=[G])
    inner = bgp(book, [("?person", AD + "email", "?m"), ("?person", AD + "firstName", "?f")], graph="?g")
    got = [tuple(r) for r in forms.order_by(sol.exists(inner), "name").select("name", "person", "g").collect()]
    assert got == [("Ling", ID + "3333", G), ("Snelson", ID + "1111", G)]


def test_values_optional_bindings(spark, book):
    names = values(spark, ["?first"], [[lit("Micah")], [lit("Fei")]])
    sol = bgp(book, [("?id", AD + "firstName", "?first"), ("?id", AD + "lastName", "?last")], graph=G).join(names)
    sol = sol.optional(pattern(book, "?id", AD + "homeTel", "?phone", graph=G))
    got = [tuple(r) for r in forms.order_by(sol, "first").select("id", "last", "first", phone=num("phone")).collect()]
    assert got == [(ID + "3333", "Ling", "Fei", None), (ID + "2222", "Dubinko", "Micah", 22222222.0)]
    pats = [("?id", AD + "firstName", "?first"), ("?id", AD + "lastName", "?last"), ("?id", AD + "homeTel", "?phone")]
    bound = bgp(book, pats, graph=G, bindings={"first": lit("Micah"), "other": "urn:x"})
    assert rows(bound.select("id", "last", "first", phone=num("phone"))) == [(ID + "2222", "Dubinko", "Micah", 22222222.0)]


def test_not_exists_of_everything_is_empty(book):
    sol = pattern(book, "?person", "?p", "?o", graph=G)
    assert sol.not_exists(pattern(book, "?person", "?p2", "?o2", graph=G)).df.count() == 0


def test_describe_construct_ask(book):
    assert forms.describe(book, ID + "3333").count() == 3
    assert forms.describe(book, AD + "firstName").count() == 0
    one = forms.construct(pattern(book, ID + "1111", AD + "email", "?e"), [(ID + "1111", AD + "email", "?e")])
    assert rows(one.select("s", "p", "o")) == [(ID + "1111", AD + "email", "john.snelson@x")]
    assert forms.ask(bgp(book, [("?x", AD + "firstName", lit("Fei"))])).first()["result"] is True
    assert forms.ask(bgp(book, [(ID + "1111", AD + "firstName", lit("Fei"))])).first()["result"] is False
    # a ground pattern that holds is one empty solution
    assert bgp(book, [(ID + "1111", AD + "firstName", lit("John"))]).df.count() == 1
    # literals are no subjects: the row is skipped
    assert forms.construct(pattern(book, ID + "1111", AD + "email", "?e"), [("?e", AD + "of", "?e")]).count() == 0


def test_terms_not_values_join(spark):
    q = statements(spark, [("urn:a", "urn:p", lit(1)), ("urn:b", "urn:q", lit("1")), ("urn:c", "urn:q", lit(1)),
                           ("urn:d", "urn:q", "urn:a"), ("urn:e", "urn:q", lit("urn:a"))])
    both = pattern(q, "?x", "urn:p", "?v").join(pattern(q, "?y", "urn:q", "?v"))
    assert rows(both.select("x", "y")) == [("urn:a", "urn:c")]
    # an object meets a subject only when it is an IRI
    chain = bgp(q, [("?y", "urn:q", "?x"), ("?x", "urn:p", "?v")])
    assert rows(chain.select("y", "x")) == [("urn:d", "urn:a")]
    assert pattern(q, "?y", "urn:q", "?v").filter(equals("v", 1)).df.count() == 1
    assert rows(pattern(q, "?y", "urn:q", "?v").filter(not_equals("v", "urn:a")).select("y")) == [
        ("urn:b",), ("urn:c",), ("urn:e",)]


def test_unbound_variables_against_brute_force(spark):
    rng = random.Random(7)

    def make(names):
        data = [tuple(rng.choice([None, "urn:1", "urn:2"]) for _ in names) for _ in range(12)]
        df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
        return data, Solutions(df, tuple(names), maybe=frozenset(names))

    for lnames, rnames in ((("a", "x"), ("x", "b")), (("x", "y"), ("x", "y", "b")), (("x", "y"), ("y", "z"))):
        ldata, left = make(lnames)
        rdata, right = make(rnames)
        shared = [v for v in lnames if v in rnames]
        want_join, want_minus = [], []
        for l in ldata:
            lb = dict(zip(lnames, l))
            hit = False
            for r in rdata:
                rb = dict(zip(rnames, r))
                if all(lb[v] is None or rb[v] is None or lb[v] == rb[v] for v in shared):
                    merged = {v: lb.get(v) if lb.get(v) is not None else rb.get(v) for v in {*lnames, *rnames}}
                    want_join.append(tuple(merged[v] for v in sorted(merged)))
                    hit = hit or any(lb[v] is not None and rb[v] is not None for v in shared)
            if not hit:
                want_minus.append(l)
        key = lambda t: tuple(str(x) for x in t)
        got = [tuple(r) for r in left.join(right).df.select(*sorted({*lnames, *rnames})).collect()]
        assert sorted(got, key=key) == sorted(want_join, key=key)
        got = [tuple(r) for r in left.minus(right).df.select(*lnames).collect()]
        assert sorted(got, key=key) == sorted(want_minus, key=key)


def test_products_of_any_size(spark):
    q = statements(spark, [(f"urn:{i}", "urn:p", lit(i)) for i in range(20)])
    left, right = pattern(q, "?a", "urn:p", "?b"), pattern(q, "?c", "urn:p", "?d")
    assert left.join(right).df.count() == 400
    none = pattern(q, "?c", "urn:none", "?d")
    assert left.join(none).df.count() == 0 and left.optional(none).df.count() == 20
    assert not any("Cartesian" in s or "NestedLoop" in s for s in [plan(left.exists(left).df)])


def test_products_do_not_depend_on_the_order_of_rows(spark):
    frame = lambda v, n, k: Solutions(spark.range(n).selectExpr(f"cast(id % {k} as string) as {v}"), (v,))
    left, right, none = frame("a", 3000, 2), frame("b", 40, 30), frame("b", 0, 1)
    for shares in (1, 7, 64):
        want = [(str(i % 2), str(j % 30)) for i in range(3000) for j in range(40)]
        both = left.join(right, shares=shares).df
        assert "monotonically_increasing_id" not in plan(both)
        assert rows(both.select("a", "b")) == rows(spark.createDataFrame(want, "a string, b string"))
        assert left.optional(right, shares=shares).df.count() == 120000
        assert rows(left.optional(none, shares=shares).df.groupBy("a", "b").count()) == [("0", None, 1500), ("1", None, 1500)]
        assert left.project().join(right, shares=shares).df.count() == 120000
    # alike rows don't share a task; more tasks than eight
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = left.join(right).df.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 20 and max(r["count"] for r in parts) < 20000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_join_equals_plain_join(spark):
    # one key holds most rows of the left side
    data = [(f"urn:o{i}", "urn:hot" if i % 3 else f"urn:c{i}") for i in range(300)]
    left = Solutions(spark.createDataFrame(data, "o string, c string"), ("o", "c"))
    right = Solutions(
        spark.createDataFrame([("urn:hot", "n1"), ("urn:hot", "n2"), ("urn:c3", "n3")], "c string, name string"),
        ("c", "name"),
    )
    assert rows(left.join(right, spread=8).df) == rows(left.join(right).df)
    assert rows(left.optional(right, spread=8).df) == rows(left.optional(right).df)


def test_spread_deals_alike_rows_and_hot_right_keys(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bag = Solutions(spark.range(3000).selectExpr("if(id % 3 > 0, 'hot', concat('c', id)) as c"), ("c",))
        few = Solutions(spark.createDataFrame([("hot", "n1"), ("c3", "n2")], "c string, name string"), ("c", "name"))
        for join in (bag.join(few, spread=16), bag.optional(few, spread=16), few.join(bag, spread=16)):
            found = join.df.where("c = 'hot'").groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in found) == 2000 and len(found) > 4 and max(r["count"] for r in found) < 1000
        assert rows(few.join(bag, spread=16).df.select("c", "name")) == rows(few.join(bag).df.select("c", "name"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_union_and_dataset_merge(spark):
    q = statements(spark, [("urn:a", "urn:p", lit(1), g) for g in ("urn:g1", "urn:g2", None)])
    assert pattern(q, "?s", "urn:p", "?o").df.count() == 1
    assert pattern(q, "?s", "urn:p", "?o", from_=["urn:g1", "urn:g2"]).df.count() == 1
    assert pattern(q, "?s", "urn:p", "?o", graph="?g").df.count() == 3
    assert pattern(q, "?s", "urn:p", "?o", graph="?g", from_named=["urn:g1"]).df.count() == 1
    u = pattern(q, "?s", "urn:p", "?o", graph="urn:g1").union(pattern(q, "?t", "urn:p", "?o", graph="urn:g2"))
    assert rows(u.select("s", "t")) == [(None, "urn:a"), ("urn:a", None)] or len(rows(u.select("o"))) == 2


# -- paths ---------------------------------------------------------------------------


def reach_of(edges):
    nodes = {n for e in edges for n in e}
    out = set()
    for a in nodes:
        seen, todo = set(), [y for x, y in edges if x == a]
        while todo:
            b = todo.pop()
            if b not in seen:
                seen.add(b)
                todo += [y for x, y in edges if x == b]
        out |= {(a, b) for b in seen}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = sorted({(f"n{rng.randrange(18)}", f"n{rng.randrange(18)}") for _ in range(26)})
    df = spark.createDataFrame(edges, "x string, y string")
    want = reach_of(edges)
    got = transitive_closure(df).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    seeds = spark.createDataFrame([("n1",), ("n2",), ("n99",)], "x string")
    got = reachable(df, seeds).collect()
    want = {p for p in want if p[0] in ("n1", "n2")}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_closure_keeps_groups_apart(spark):
    df = spark.createDataFrame([("g1", "a", "b"), ("g2", "b", "c"), ("g1", "b", "d")], "g string, x string, y string")
    got = {tuple(r) for r in transitive_closure(df, ("g",)).collect()}
    assert got == {("g1", "a", "b"), ("g2", "b", "c"), ("g1", "b", "d"), ("g1", "a", "d")}


def test_paths_on_citations(spark):
    cites = [("J", "K2"), ("K2", "L"), ("K2", "K2"), ("L", "M")]
    q = statements(spark, [("urn:" + a, "urn:cites", "urn:" + b) for a, b in cites])
    back = pattern(q, "urn:K2", paths.inverse("urn:cites"), "?s").filter(var("s") != "urn:K2")
    assert rows(back.select("s")) == [("urn:J",)]
    plus = pattern(q, "?x", paths.plus("urn:cites"), "urn:M")
    assert rows(plus.select("x")) == [("urn:J",), ("urn:K2",), ("urn:L",)]
    both = pattern(q, "urn:J", paths.plus("urn:cites"), "urn:M")
    assert both.df.count() == 1
    loop = pattern(q, "?x", paths.plus("urn:cites"), "?x")
    assert rows(loop.select("x")) == [("urn:K2",)]
    star = pattern(q, "urn:nowhere", paths.star("urn:cites"), "?y")
    assert rows(star.select("y")) == [("urn:nowhere",)]
    neg = pattern(q, "?x", paths.not_in("urn:other", backward=("urn:cites",)), "?y")
    assert neg.df.count() == 4


# -- forms ---------------------------------------------------------------------------


def test_pages_fit_together(spark):
    q = statements(spark, [(f"urn:{i:03}", "urn:p", lit(i % 7)) for i in range(40)])
    sol = pattern(q, "?s", "urn:p", "?o")
    keys = forms.sort_columns(sol, ["-o", "s"])
    whole = [r["s"] for r in sol.df.orderBy(*keys).collect()]

    def page(start, length):
        return [r["s"] for r in forms.page(sol.df, keys, start, length, deep).collect()]

    for deep in (False, True):
        pages = [page(i, 9) for i in range(1, 41, 9)]
        assert list(itertools.chain(*pages)) == whole and len(pages[-1]) == 4
        assert page(1, 0) == whole and page(11, -1) == whole[10:]
        assert page(39, 10) == whole[38:] and page(41, 2) == []
    with pytest.raises(ValueError):
        page(0, 5)


def test_order_of_mixed_terms(spark):
    q = statements(spark, [("urn:1", "urn:p", lit("b")), ("urn:2", "urn:p", lit(10)), ("urn:3", "urn:p", "urn:z"),
                           ("urn:4", "urn:p", lit(9.5)), ("urn:5", "urn:p", lit("2020-01-01", dt=V.XSD_DATE))])
    sol = values(spark, ["s"], [[f"urn:{i}"] for i in range(1, 7)]).optional(pattern(q, "?s", "urn:p", "?o"))
    got = [r["s"] for r in forms.order_by(sol, "o").select("s").collect()]
    assert got == ["urn:6", "urn:3", "urn:4", "urn:2", "urn:5", "urn:1"]


def test_handler_sees_every_row(spark, book, tmp_path):
    target = str(tmp_path)

    def handler(rows):
        import uuid

        with open(f"{target}/{uuid.uuid4().hex}", "w") as f:
            f.writelines(r["o"] + "\n" for r in rows)

    forms.for_each(book.select("o"), handler)
    lines = [line for f in tmp_path.iterdir() for line in f.read_text().splitlines()]
    assert len(lines) == book.count()
    before = len(list(tmp_path.iterdir()))
    forms.for_each(book.where("o = 'nothing'").select("o"), handler)
    assert len(list(tmp_path.iterdir())) == before


def test_set_functions(spark):
    q = statements(spark, [("urn:a", "urn:p", lit(1)), ("urn:a", "urn:p", lit("1")), ("urn:b", "urn:p", lit(2)), ("urn:b", "urn:p", lit(3))])
    sol = pattern(q, "?s", "urn:p", "?o")
    got = A.group(sol, ["s"], n=A.count_distinct(sol, "o"), total=A.sum_("o"), mean=A.avg("o"))
    assert rows(got) == [("urn:a", 2, None, None), ("urn:b", 2, 5.0, 2.5)]
    none = pattern(q, "urn:none", "urn:p", "?o")
    assert rows(A.group(none, n=A.count("o"), total=A.sum_("o"), mean=A.avg("o"))) == [(0, 0.0, 0.0)]


def test_group_concat(spark):
    q = statements(spark, [("urn:a", "urn:p", lit("x" * 30)), ("urn:a", "urn:p", lit("y" * 30))])
    sol = pattern(q, "?s", "urn:p", "?o")
    assert A.group_concat(sol, ["s"], "o", "all", ",").first()["all"] == "x" * 30 + "," + "y" * 30


def test_an_iri_differs_from_a_number(spark):
    q = statements(spark, [("urn:a", "urn:p", lit(5)), ("urn:b", "urn:p", "urn:x"), ("urn:c", "urn:p", lit(6)), ("urn:d", "urn:p", lit("t"))])
    sol = pattern(q, "?s", "urn:p", "?o")
    assert rows(sol.filter(not_equals("o", 5)).df.select("s")) == [("urn:b",), ("urn:c",)]


def test_bind_keeps_language(spark):
    q = statements(spark, [("urn:a", "urn:p", lit("Ling", lang="zh")), ("urn:a", "urn:q", lit(4))])
    sol = bgp(q, [("?s", "urn:p", "?o"), ("?s", "urn:q", "?n")])
    sol = sol.bind("up", F.upper("o"), like="o").bind("twice", num("n") * 2, dt=V.XSD_DOUBLE).bind("k", lit("c"))
    row = sol.df.first()
    assert (row["up"], row["up__lang"], row["twice__num"], row["k"]) == ("LING", "zh", 8.0, "c")
    with pytest.raises(ValueError):
        sol.bind("up", F.lit("x"))


def _plain_join(left, right, shared, others):
    """Compatible rows, by hand."""
    out = []
    for a in left:
        for b in right:
            if all(a[v] is None or b[v] is None or a[v] == b[v] for v in shared):
                out.append(tuple(a[v] if a[v] is not None else b[v] for v in shared) + (a[others[0]], b[others[1]]))
    return sorted(out, key=str)


def test_join_on_any_number_of_open_variables(spark):
    """All ways to leave variables unbound on both sides, repeated rows included."""
    r = random.Random(11)
    for names in (["x"], ["x", "y"], ["x", "y", "z", "w"]):
        sides = []
        for tag in "lr":
            rows_ = [{**{n: r.choice([None, "urn:1", "urn:2"]) for n in names}, tag: f"urn:{tag}{i % 9}"} for i in range(14)]
            df = spark.createDataFrame([tuple(x.values()) for x in rows_], ", ".join(f"{n} string" for n in [*names, tag]))
            sides.append((rows_, Solutions(df, (*names, tag), maybe=frozenset(names))))
        (lrows, left), (rrows, right) = sides
        got = left.join(right, shares=4)
        assert sorted(map(tuple, got.select(*names, "l", "r").collect()), key=str) == _plain_join(lrows, rrows, names, "lr")
        plan = got.df._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Join " in line for line in plan.splitlines()) == 2


def test_open_variables_of_terms(spark):
    """Literals join by datatype and language, not by their text alone."""
    left = values(spark, ["a", "b", "l"], [[lit("1"), None, lit("p")], [lit(1), "urn:x", lit("q")], [None, None, lit("s")]])
    right = values(spark, ["a", "b", "m"], [[lit(1), None, lit("t")], [None, "urn:x", lit("u")], [lit("1", lang="en"), "urn:y", lit("v")]])
    got = {(r["l"], r["m"], r["a"], r["b"]) for r in left.join(right).select("l", "m", "a", "b").collect()}
    assert got == {("p", "u", "1", "urn:x"), ("q", "t", "1", "urn:x"), ("q", "u", "1", "urn:x"), ("s", "t", "1", None), ("s", "u", None, "urn:x"), ("s", "v", "1", "urn:y")}


def test_optional_with_hot_keys_on_both_sides(spark):
    r = random.Random(5)
    lrows = [("urn:hot" if i % 3 == 0 else "urn:left" if i % 3 == 1 else f"urn:k{i}", f"urn:l{i % 50}", i % 7) for i in range(240)]
    rrows = [("urn:hot" if i % 2 else f"urn:k{r.randrange(240)}", f"urn:r{i % 40}", i % 5) for i in range(200)]
    ldf = spark.createDataFrame(lrows, "k string, l string, n long")
    rdf = spark.createDataFrame(rrows, "k string, r string, m long")
    left, right = Solutions(ldf, ("k", "l", "n")), Solutions(rdf, ("k", "r", "m"))
    for condition, holds in ((None, lambda n, m: True), (F.col("n") < F.col("m"), lambda n, m: n < m)):
        want = []
        for k, l, n in lrows:
            found = [(k, l, x) for k2, x, m in rrows if k == k2 and holds(n, m)]
            want += found or [(k, l, None)]
        got = left.optional(right, condition, spread=8).select("k", "l", "r")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)

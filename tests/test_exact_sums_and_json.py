"""Exact sums against fractions, RDF/JSON files in small byte ranges, catalogue of predicates, two-ended paths."""

import json
import random
from decimal import Decimal, localcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.terms import numeric_value
from quadloom.operators.exact_sums import exact_sums
from quadloom.operators.solutions import Solutions
from quadloom.sources import readers
from quadloom.sources.json_subjects import subjects


def numbers(spark, rows):
    df = spark.createDataFrame(rows, "g string, t string, dt string")
    return Solutions(
        df.select(
            "g", F.col("t").alias("x"), F.lit("lit").alias("x__kind"), F.col("dt").alias("x__dt"),
            F.lit(None).cast("string").alias("x__lang"), numeric_value("t", "dt").alias("x__num"), F.lit(None).cast("timestamp_ntz").alias("x__ts"),
        ),
        ("g", "x"),
        frozenset("x"),
    )


def test_sums_and_averages_of_any_length(spark):
    r = random.Random(3)
    rows = []
    for i in range(300):
        whole = "".join(r.choice("0123456789") for _ in range(r.choice([1, 3, 9, 10, 18, 27, 60, 100])))
        fraction = "" if i % 13 < 6 else "." + "".join(r.choice("0123456789") for _ in range(r.choice([1, 9, 12, 40])))
        rows.append((f"g{i % 13}", r.choice(["", "-", "+"]) + whole + fraction, V.XSD_INTEGER if i % 13 < 6 else V.XSD_DECIMAL))
    rows += [("zero", "0", V.XSD_INTEGER), ("zero", "-000", V.XSD_INTEGER), ("gone", "1", V.XSD_INTEGER), ("gone", "-1", V.XSD_INTEGER)]
    rows += [("carry", "-1000000000", V.XSD_INTEGER), ("carry", "999999999", V.XSD_INTEGER), ("small", "0.1", V.XSD_DECIMAL), ("small", "-0.3", V.XSD_DECIMAL)]
    got = {x["g"]: x for x in exact_sums(numbers(spark, rows), ["g"], "x").collect()}
    with localcontext() as ctx:
        ctx.prec = 300
        for g, x in got.items():
            values = [Decimal(t) for h, t, _ in rows if h == g]
            assert Decimal(x["sum"]) == sum(values) and "E" not in x["sum"] and x["n"] == len(values)
            whole = all(dt == V.XSD_INTEGER for h, _, dt in rows if h == g)
            assert x["sum_dt"] == (V.XSD_INTEGER if whole else V.XSD_DECIMAL) and x["avg_dt"] == V.XSD_DECIMAL
            # cut off behind the places of the values and 18 more
            rest = abs(Fraction(sum(values))) / len(values) - Fraction(abs(Decimal(x["avg"])))
            assert 0 <= rest < Fraction(1, 10**18)
    assert got["carry"]["sum"] == "-1" and got["carry"]["avg"] == "-0.5" and got["small"]["sum"] == "-0.2" and got["zero"]["sum"] == "0"


def test_sums_of_other_groups(spark):
    rows = [("none", None, V.XSD_INTEGER), ("bad", "5", V.XSD_INTEGER), ("bad", "x", V.XSD_STRING), ("float", "5", V.XSD_INTEGER), ("float", "0.5", V.XSD_DOUBLE)]
    got = {x["g"]: (x["n"], x["sum"], x["sum_dt"], x["avg"]) for x in exact_sums(numbers(spark, rows), ["g"], "x").collect()}
    assert got == {"none": (0, "0", V.XSD_INTEGER, "0"), "bad": (2, None, None, None), "float": (2, "5.5", V.XSD_DOUBLE, "2.75")}
    (alone,) = exact_sums(numbers(spark, rows[:1]), [], "x").collect()
    assert alone["n"] == 0 and alone["sum"] == "0"


# -- RDF/JSON ----------------------------------------------------------------------------


@pytest.fixture
def small_ranges(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


ODD = ['a "quote" {', "}}", "\\", 'ends with \\"', "{}[]", "line\nbreak\ttab", "é漢 }", "", '"', '\\"}', "," * 40]


@pytest.mark.parametrize("indent", [None, 1])
def test_a_file_is_cut_at_its_subjects(spark, tmp_path, small_ranges, indent):
    r = random.Random(1)
    want, files = set(), []
    for f in range(3):
        document = {}
        for i in range(25):
            s = f"urn:{f}:{i}" + ("}{" if i % 5 == 0 else "")
            document[s] = {f"urn:p{j}": [{"value": r.choice(ODD) + str(i), "type": "literal"} for _ in range(j)] for j in range(r.randint(0, 3))}
            want |= {(s, p, o["value"]) for p, os in document[s].items() for o in os}
        path = tmp_path / f"f{f}.rj"
        path.write_text(json.dumps(document, indent=indent, ensure_ascii=f == 1) + "\n" * f)
        files.append(str(path))
    got = readers.load(spark, files, "rdfjson")
    assert {(x["s"], x["p"], x["o"]) for x in got.collect()} == want
    lines = subjects(spark, files)
    assert lines.count() == 75 and spark.read.text(files).rdd.getNumPartitions() > 20


def test_files_without_subjects_and_malformed_ones(spark, tmp_path, small_ranges):
    def read(text, mode=readers.FAILFAST):
        path = tmp_path / f"x{abs(hash(text))}.rj"
        path.write_text(text)
        return readers.load(spark, str(path), "rdfjson", mode=mode)

    assert read("{}").count() == 0 and read(" { }\n").count() == 0 and read("").count() == 0
    for bad in ('{"urn:a": {"urn:p": [{"value": "x", "type": "literal"', '[1, 2]', '{"urn:a": 5}', 'nonsense {"urn:a": {}}'):
        with pytest.raises(Exception):
            read(bad).collect()


# -- paths between two sets, catalogue, intermediate folders -----------------------------


def test_paths_between_two_sets(spark):
    import itertools

    from quadloom.operators.closure import between, reachable

    r = random.Random(4)
    edges = [(f"n{r.randrange(40)}", f"n{r.randrange(40)}") for _ in range(45)] + [(f"c{i}", f"c{i + 1}") for i in range(20)] + [("r1", "r2"), ("r2", "r1")]
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)

    def reach(x):
        seen, todo = set(), list(after.get(x, ()))
        while todo:
            y = todo.pop()
            if y not in seen:
                seen.add(y)
                todo += after.get(y, ())
        return seen

    df = spark.createDataFrame(edges, "x string, y string")
    for starts, ends in (([f"n{i}" for i in range(0, 40, 3)] + ["c0", "r1"], [f"n{i}" for i in range(0, 40, 7)] + ["c20", "r1", "c3"]), (["c0"], ["c2"]), (["c19"], [f"c{i}" for i in range(21)]), ([], ["c1"]), (["zz"], ["c1"])):
        s, e = (spark.createDataFrame([(x,) for x in xs], "x string") for xs in (starts, ends))
        want = {(x, y) for x, y in itertools.product(starts, ends) if y in reach(x)}
        assert {tuple(p) for p in between(df, s, e).collect()} == want
        assert {tuple(p) for p in reachable(df, s).collect()} == {(x, y) for x in starts for y in reach(x)}


def test_paths_from_the_side_that_reaches_less(spark, monkeypatch):
    """A chain of 60 with its second node as the end: the walk from the end is over in one round."""
    from quadloom.operators import closure

    rounds, step = [], closure._Walk.step
    monkeypatch.setattr(closure._Walk, "step", lambda self: (rounds.append(self.root.rsplit("/", 1)[1]), step(self))[1])
    df = spark.createDataFrame([(f"c{i:02d}", f"c{i + 1:02d}") for i in range(60)], "x string, y string")
    one = lambda x: spark.createDataFrame([(x,)], "x string")
    assert [tuple(p) for p in closure.between(df, one("c00"), one("c01")).collect()] == [("c00", "c01")]
    assert len(rounds) <= 3


def test_patterns_pass_both_ends_to_paths(spark, monkeypatch):
    from quadloom import lit
    from quadloom.functions.quad_columns import statements
    from quadloom.operators import paths
    from quadloom.operators.patterns import bgp

    rows = [(f"urn:{i}", "urn:next", f"urn:{i + 1}") for i in range(9)] + [("urn:2", "urn:is", lit("start")), ("urn:7", "urn:is", lit("end")), ("urn:0", "urn:is", lit("end"))]
    q = statements(spark, rows)
    used = []
    monkeypatch.setattr(paths, "between", lambda *a: used.append(1) or between_(*a))
    from quadloom.operators.closure import between as between_

    both = [("?x", paths.plus("urn:next"), "?y"), ("?x", "urn:is", lit("start")), ("?y", "urn:is", lit("end"))]
    assert [tuple(r) for r in bgp(q, both).select("x", "y").collect()] == [("urn:2", "urn:7")] and used
    ends = [("?x", paths.seq("urn:next", paths.plus("urn:next")), "?y"), ("?y", "urn:is", lit("end"))]
    assert sorted(tuple(r) for r in bgp(q, ends).select("x", "y").collect()) == [(f"urn:{i}", "urn:7") for i in range(6)]


def test_the_catalogue_spares_merging_graphs(spark):
    from quadloom.functions.quad_columns import statements
    from quadloom.operators.patterns import pattern
    from quadloom.session import scratch_path
    from quadloom.sources.snapshots import SnapshotStore

    store = SnapshotStore(spark, scratch_path(spark, "store"), catalogue=True)
    store.add(statements(spark, [("urn:a", "urn:p", "urn:x", "urn:g1"), ("urn:a", "urn:q", "urn:x", "urn:g1")]))
    store.add(statements(spark, [("urn:a", "urn:q", "urn:x", "urn:g2")]))

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    alone = pattern(store.quads(), "?s", "urn:p", "?o")
    shared = pattern(store.quads(), "?s", "urn:q", "?o")
    assert alone.df.count() == 1 and shared.df.count() == 1
    # two writes are merged once, by quad; only the shared predicate is merged by triple as well
    assert plan(shared.df).count("Aggregate") == plan(alone.df).count("Aggregate") + 1
    assert pattern(store.quads(), "?s", "urn:q", "?o", merge=False).df.count() == 2
    assert pattern(store.quads(), "?s", "?p", "?o").df.count() == 2


def test_intermediate_folders_are_removed(spark):
    import os

    from quadloom.operators.closure import transitive_closure
    from quadloom.session import scratch_path, temporary

    df = spark.createDataFrame([("a", "b"), ("b", "c")], "x string, y string")
    with temporary(spark):
        inside = scratch_path(spark, "inside")
        assert transitive_closure(df).count() == 3
        df.write.parquet(inside)
        with temporary(spark):
            nested = scratch_path(spark, "nested")
            df.write.parquet(nested)
        assert os.path.exists(inside) and not os.path.exists(nested)
    outside = scratch_path(spark, "outside")
    df.write.parquet(outside)
    assert not os.path.exists(inside) and os.path.exists(outside)

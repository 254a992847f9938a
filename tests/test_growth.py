"""Steps whose tasks must not grow with what one task has read: merging, stored parts, sums, few keys with many pairs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.quad_columns import statements, with_values
from quadloom.model import QUAD_KEY
from quadloom.operators import inference as I
from quadloom.operators import solutions as S
from quadloom.operators.exact_sums import exact_sums
from quadloom.operators.solutions import Solutions
from quadloom.operators.updates import distinct_quads
from quadloom.session import _CLEANUP
from quadloom.sources import snapshots
from quadloom.sources.snapshots import SnapshotStore


def _quads(spark, n: int, doc: str | None = None):
    return with_values(spark.range(n).select(
        F.lit("urn:g").alias("g"), F.concat(F.lit("urn:s"), (F.col("id") % 50).cast("string")).alias("s"), F.lit("urn:p").alias("p"),
        F.lit("x").alias("o"), F.lit("lit").alias("o_kind"), F.lit(V.XSD_STRING).alias("o_dt"), F.lit(None).cast("string").alias("o_lang"),
        F.lit(doc).cast("string").alias("doc_id"),
    ))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quads_are_merged_behind_an_exchange(spark):
    df = distinct_quads(_quads(spark, 500, "b").union(_quads(spark, 100, "a")))
    assert {(r["s"], r["doc_id"]) for r in df.collect()} == {(f"urn:s{k}", "a") for k in range(50)}
    lines = _plan(df).split("\n")
    merged = [k for k, line in enumerate(lines) if "Aggregate" in line]
    assert any("Exchange" in line for line in lines[max(merged) + 1:])  # nothing is merged where it is read


def test_parts_of_a_batch_are_one_write(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    for _ in range(2):  # what is delivered again replaces itself
        store.add(_quads(spark, 500, "d"), batch="b", parts=3)
    assert {p.name for p in (tmp_path / "store").glob("batch=*")} == {"batch=b-0", "batch=b-1", "batch=b-2"}
    assert store.read().count() == 50 and store.members().count() == 50
    store.add(_quads(spark, 500), batch="c", parts=1)
    assert store.read().count() == 50


def test_rows_for_several_orders_are_merged_once(spark, tmp_path, monkeypatch):
    """Rows that have no equal are not shuffled to be compared; orders are written in steps and seen when they are whole."""
    monkeypatch.setattr(snapshots, "SHUFFLED", 28, raising=False)
    whole, compared = snapshots.distinct_quads, []
    monkeypatch.setattr(snapshots, "distinct_quads", lambda df: compared.append(df.count()) or whole(df))
    before = spark.conf.get(_CLEANUP, None)
    held = tmp_path / "held"
    monkeypatch.setattr(snapshots, "scratch_path", lambda _, label: f"{held}/{label}")
    one = _quads(spark, 50, "d")  # 50 quads, each once
    again = one.union(_quads(spark, 3, "c")).union(_quads(spark, 2))
    for k, (rows, repeats, count) in enumerate([(one, 1000, []), (again, 1000, [8]), (again, 0, [55])]):
        monkeypatch.setattr(snapshots, "REPEATS", repeats, raising=False)
        compared.clear()
        store = SnapshotStore(spark, str(tmp_path / f"store{k}"), copies=("s", "o"))
        store.add(rows, batch="b")
        assert compared == count
        for copy in (None, "s", "o"):
            got = [tuple(r) for r in store.read(copy=copy).select(*QUAD_KEY).collect()]
            assert len(got) == len(set(got)) == 50
            assert [p.name for p in (tmp_path / (f"store{k}" + (f"-by-{copy}" if copy else ""))).iterdir()] == ["batch=b"]
        assert store.members().count() == (50 if k == 0 else 53)
        docs = [r["doc_id"] for r in store.read().where("s = 'urn:s1'").collect()]
        assert docs == ["d" if k == 0 else "c"]
    assert spark.conf.get(_CLEANUP, None) == before and not list(held.glob("*"))


def test_usual_numbers_need_no_row_per_limb(spark):
    numbers = ["-7", "000012345678901234567890123456789012345", "9" * 45, "9" * 46, "-" + "8" * 60, "0", "1" * 19]
    sol = Solutions(spark.createDataFrame([(n,) for n in numbers], "t string"), ()).bind("x", F.col("t"), V.XSD_INTEGER)
    got = exact_sums(sol, [], "x")
    assert "place0__" in got._jdf.queryExecution().analyzed().toString()
    (row,) = got.collect()
    assert (row["n"], row["sum"], row["sum_dt"]) == (7, str(sum(map(int, numbers))), V.XSD_INTEGER)
    short = Solutions(spark.createDataFrame([("1.5",), ("-0.000000000000000001",), ("2.0000000000000000001",)], "t string"), ())
    (row,) = exact_sums(short.bind("x", F.col("t"), V.XSD_DECIMAL), [], "x").collect()
    assert row["sum"] == "3.4999999999999999991"


def test_few_keys_are_dealt_to_a_fixed_number_of_tasks(spark):
    left = Solutions(spark.range(300).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").cast("string").alias("a")), ("k", "a"))
    right = Solutions(spark.range(40).select((F.col("id") % 4).cast("string").alias("k"), F.col("id").cast("string").alias("b")), ("k", "b"))
    left, right = (left.df.union(left.df.limit(5)), right.df)
    left, right = Solutions(left, ("k", "a")), Solutions(right, ("k", "b"))
    dealt = left.join(right, shares=4).df.select("k", "a", "b")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(dealt) == rows(left.join(right).df.select("k", "a", "b"))
    assert "REPARTITION_BY_NUM" in _plan(dealt)


def test_pairs_of_few_keys_come_part_after_part(spark, monkeypatch):
    """Each right row goes with a bounded part of left ones, so what is written repeats; tasks follow the rows of both sides."""
    monkeypatch.setattr(S, "SHARED", 16, raising=False)
    monkeypatch.setattr(S, "DEALT", 20, raising=False)
    a = spark.range(200).select(F.when(F.col("id") > 0, F.lit("k")).alias("k"), (F.col("id") % 190).cast("string").alias("a"))
    b = spark.range(31).select(F.when(F.col("id") > 0, F.lit("k")).alias("k"), F.col("id").cast("string").alias("b"))
    left, right = Solutions(a, ("k", "a")), Solutions(b, ("k", "b"))
    dealt = left.join(right, shares=2).df.select("k", "a", "b")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got, plan = [tuple(r) for r in dealt.collect()], _plan(dealt)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(got) == sorted(map(tuple, left.join(right).df.select("k", "a", "b").collect())) and len(got) == 199 * 30
    assert sum(x[2] != y[2] for x, y in zip(got, got[1:])) <= 30 * 14
    assert {int(x) for x in re.findall(r", (\d+)\), REPARTITION_BY_NUM", plan)} <= {30, 31}
    # terms, a left side without further variables, and alike rows
    terms = [Solutions(spark.createDataFrame([("1",), ("1",), ("2",)], "t string"), ()).bind("x", F.col("t"), V.XSD_INTEGER) for _ in "lr"]
    assert terms[0].join(terms[1], shares=3).df.where("x__num is not null").count() == 5


def test_inferred_facts_are_merged_behind_an_exchange(spark):
    """A task that expands facts by the rules holds none of what follows; a fact that many give is merged per task first."""
    facts = statements(spark, [("urn:a", "urn:p", "urn:b"), ("urn:a", "urn:q", "urn:b"), ("urn:c", "urn:p", "urn:b")])
    plain = [("urn:p", V.EQUIVALENT_PROPERTY, "urn:q"), ("urn:q", V.EQUIVALENT_PROPERTY, "urn:r")]
    for rules, hot in ((plain, False), ([*plain, ("urn:r", V.RANGE, "urn:C")], True)):
        known = facts.union(statements(spark, rules)).select(*I.FACT)
        d = I.close_declarations(known, I.rules_of(["RDFS_PLUS"]))
        assert d.hot == hot
        new = I.infer_with(known, d)
        want = {("urn:a", "urn:r", "urn:b"), ("urn:c", "urn:q", "urn:b"), ("urn:c", "urn:r", "urn:b")} | ({("urn:b", V.RDF_TYPE, "urn:C")} if hot else set())
        got = [(r["s"], r["p"], r["o"]) for r in new.where(~F.col("p").isin(*I.DECLARING)).collect()]
        assert set(got) == want and len(got) == len(want)
        lines = _plan(new).split("\n")
        expanded = min(k for k, line in enumerate(lines) if "Generate inline" in line)
        above = [line for line in lines[:expanded] if "Exchange" in line or "Aggregate" in line]
        assert "Exchange" in above[-1] and "hash__" in above[-1]  # nothing is merged where facts are expanded
        assert sum("Exchange" in line for line in above) == (2 if hot else 1)
        assert not d.wide and "REPARTITION_BY_NUM" not in _plan(new)
    names = [f"urn:p{k}" for k in range(I.WIDE + 1)]
    wide = [(a, V.EQUIVALENT_PROPERTY, b) for a, b in zip(names, names[1:])]
    known = statements(spark, [*wide, ("urn:a", "urn:p0", "urn:b")]).select(*I.FACT)
    d = I.close_declarations(known, I.rules_of(["RDFS_PLUS"]))
    new = I.infer_with(known, d)
    assert d.wide and "REPARTITION_BY_NUM" in _plan(new)
    assert sorted(r["p"] for r in new.where("s = 'urn:a'").collect()) == names[1:]


def test_many_inferred_facts_get_tasks_by_their_bytes(spark, monkeypatch):
    """Where one fact gives many, more results are merged by more tasks, and facts are dealt out before they are expanded."""
    monkeypatch.setattr(I, "MERGED", 20_000, raising=False)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"urn:p{k}" for k in range(I.WIDE + 4)]
    links = [(a, V.EQUIVALENT_PROPERTY, b) for a, b in zip(names, names[1:])]
    numbers = []
    for n in (20, 200, 400):
        stated = [(f"urn:s{k}", "urn:p0", f"urn:o{k % 7}") for k in range(n)]
        known = statements(spark, [*links, *stated, *stated[:5]]).select(*I.FACT)
        new = I.infer_with(known, I.close_declarations(known, I.rules_of(["RDFS_PLUS"])))
        got = [(r["s"], r["p"], r["o"]) for r in new.where(F.col("s").startswith("urn:s")).collect()]
        assert sorted(got) == sorted((s, p, o) for s, _, o in stated for p in names[1:])
        plan = _plan(new)
        lines = plan.split("\n")
        expanded = min(k for k, line in enumerate(lines) if "Generate inline" in line)
        assert "REPARTITION_BY_NUM" in next(line for line in lines[expanded:] if "Exchange" in line)
        numbers.append(max(int(x) for x in re.findall(r"hash__#\S+?, (\d+)\), REPARTITION_BY_NUM", plan)))
    assert numbers[0] >= least and numbers[1] > 2 * least and 1.5 < numbers[2] / numbers[1] < 2.5

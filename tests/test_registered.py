"""Every registered query against DuckDB, on the smallest tables."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from quadloom import lit
from quadloom.operators.patterns import pattern, values
from quadloom.plans.mapping import G, P, quads

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer", "name", "nation", "region"] and df.count() == 150


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


def test_constants_and_columns_reach_the_scan(spark):
    subject = plan(entry.queries()["scan_by_subject"](spark, SF_DIR))
    assert "EqualTo(c_custkey,7)" in subject and "c_mktsegment:string" in subject
    # one predicate of one table: two columns are read
    segment = plan(entry.queries()["graph_const"](spark, SF_DIR))
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double,c_mktsegment:string>" in segment
    assert "GreaterThan(c_acctbal,5000.0)" in segment
    numbers = plan(entry.queries()["filter_numeric_range"](spark, SF_DIR))
    assert "GreaterThanOrEqual(c_acctbal,1000.0)" in numbers and "Union" not in numbers


@pytest.mark.parametrize(
    "name",
    ["bgp_unrelated_patterns", "bgp_order_parts_nation", "not_exists_customers_without_urgent_open_order"],
)
def test_no_cartesian_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_unbound_variables_give_no_cartesian_join(spark):
    # with a constant as its only value (the flag 'true') Catalyst turns the key into a filter on the inline
    # table and loops over what is left of it; with varying values it is a hash join
    assert "CartesianProduct" not in plan(entry.queries()["optional_then_join"](spark, SF_DIR))
    q = quads(spark, SF_DIR)
    base = pattern(q, "?c", P + "name", "?name", graph=G + "customer")
    maybe = base.optional(pattern(q, "?c", P + "segment", "?seg", graph=G + "vip"))
    table = values(spark, ["seg", "label"], [[lit("BUILDING"), lit("b")], [lit("MACHINERY"), lit("m")]])
    text = plan(maybe.join(table).df)
    assert "CartesianProduct" not in text and "NestedLoop" not in text

"""Registered queries: property paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom import lit
from quadloom.operators.closure import reachable
from quadloom.operators.paths import alt, inverse, not_in, optional_step, plus, seq, star
from quadloom.operators.patterns import bgp, pattern
from quadloom.plans.mapping import G, P, quads
from quadloom.plans.registry import query

NEXT = P + "next"


@query("""
select 'urn:customer:' || c_custkey as c, 'urn:region:' || n_regionkey as r
from customer join nation on c_nationkey = n_nationkey
""")
def path_sequence(spark, sf_dir):
    path = seq(P + "inNation", P + "inRegion")
    sol = pattern(quads(spark, sf_dir), "?c", path, "?r", from_=[G + "customer", None])
    return sol.select("c", "r")


@query("""
select 'urn:order:' || o_orderkey as o, n_name as nation
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""")
def path_sequence_to_literal(spark, sf_dir):
    path = seq(P + "placedBy", P + "inNation", P + "name")
    sol = pattern(quads(spark, sf_dir), "?o", path, "?nation", from_=[G + "orders", G + "customer", None])
    return sol.select("o", "nation")


@query("select 'urn:customer:' || o_custkey as c, 'urn:order:' || o_orderkey as o from orders")
def path_inverse(spark, sf_dir):
    return pattern(quads(spark, sf_dir), "?c", inverse(P + "placedBy"), "?o", graph=G + "orders").select("c", "o")


@query("""
select 'urn:customer:' || a.c_custkey as c, 'urn:customer:' || b.c_custkey as d
from customer a join customer b on a.c_nationkey = b.c_nationkey where a.c_custkey = 42
""")
def path_inverse_sequence(spark, sf_dir):
    """Customers of the same nation as one customer: there and back again."""
    path = seq(P + "inNation", inverse(P + "inNation"))
    sol = pattern(quads(spark, sf_dir), "urn:customer:42", path, "?d", graph=G + "customer")
    return sol.select("d", c=F.lit("urn:customer:42"))


@query("""
select 'urn:part:' || p_partkey as part, p_name as label from part
union all select 'urn:part:' || p_partkey, p_brand from part
""")
def path_alternative(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?part", alt(P + "name", P + "brand"), "?label", graph=G + "part")
    return sol.select("part", "label")


@query("""
select 'urn:customer:' || c_custkey as c, 'urn:customer:' || c_custkey as y from customer
union select 'urn:customer:' || c_custkey, 'urn:nation:' || c_nationkey from customer
union select 'urn:nation:' || c_nationkey, 'urn:nation:' || c_nationkey from customer
union select c_name, c_name from customer union select c_mktsegment, c_mktsegment from customer
union select 'true', 'true' from customer where c_acctbal > 5000
""")
def path_optional(spark, sf_dir):
    """p?: every term of the graph reaches itself, customers also their nation."""
    sol = pattern(quads(spark, sf_dir), "?c", optional_step(P + "inNation"), "?y", graph=G + "customer")
    # balances are numbers and have no common text form
    return sol.filter(F.col("c__num").isNull()).select("c", "y")


@query("""
select 'urn:supplier:' || s_suppkey as s, 'urn:nation:' || s_nationkey as o from supplier
""")
def path_negated_set(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?s", not_in(P + "name", P + "acctbal"), "?o", graph=G + "supplier")
    return sol.select("s", "o")


@query("""
select 'urn:turn:' || a.conv_id || '-' || a.turn as x, 'urn:turn:' || b.conv_id || '-' || b.turn as y
from conversations a join conversations b on a.conv_id = b.conv_id and a.turn < b.turn
""")
def path_plus_acyclic(spark, sf_dir):
    """All later turns of every conversation."""
    return pattern(quads(spark, sf_dir), "?x", plus(NEXT), "?y", graph=G + "conv").select("x", "y")


@query("""
select 'urn:nation:' || a.n_nationkey as x, 'urn:nation:' || b.n_nationkey as y from nation a, nation b
""")
def path_plus_cycle(spark, sf_dir):
    """The nations form one ring, so each reaches all."""
    return pattern(quads(spark, sf_dir), "?x", plus(NEXT), "?y", graph=None, from_=[None]).select("x", "y")


@query("""
select 'urn:nation:' || n_nationkey as y from nation
""")
def path_star_fixed_start(spark, sf_dir):
    """Only what the fixed start reaches is computed."""
    return pattern(quads(spark, sf_dir), "urn:nation:7", star(NEXT), "?y", from_=[None]).select("y")


@query("""
select 'urn:nation:' || n_nationkey as x, 'urn:nation:' || n_nationkey as y from nation
union all select 'urn:region:' || r_regionkey, 'urn:region:' || r_regionkey from region
union all select n_name, n_name from nation
union all select r_name, r_name from region
union all select 'urn:nation:' || a.n_nationkey, 'urn:nation:' || b.n_nationkey
from nation a join nation b on a.n_nationkey <> b.n_nationkey
""")
def path_star_cycle(spark, sf_dir):
    return pattern(quads(spark, sf_dir), "?x", star(NEXT), "?y", from_=[None]).select("x", "y")


@query("""
select 'urn:turn:' || conv_id || '-' || turn as x from conversations
where turn < 3 and conv_id = 0
""")
def path_plus_fixed_end(spark, sf_dir):
    """Turns from which turn 3 of the first conversation is reached."""
    return pattern(quads(spark, sf_dir), "?x", plus(NEXT), "urn:turn:0-3", graph=G + "conv").select("x")


@query("""
select 'urn:turn:' || a.conv_id || '-0' as x, 'urn:turn:' || b.conv_id || '-' || b.turn as y
from conversations a join conversations b on a.conv_id = b.conv_id
where a.turn = 0 and b.turn > 0
""")
def path_plus_from_seeds(spark, sf_dir):
    """Many starts at once: the first turns, found by a pattern."""
    q = quads(spark, sf_dir)
    edges = pattern(q, "?x", NEXT, "?y", graph=G + "conv").select("x", "y")
    firsts = edges.join(edges.select(F.col("y").alias("x")), "x", "left_anti").select("x")
    return reachable(edges, firsts)


@query("""
select 'urn:turn:' || a.conv_id || '-' || a.turn as x, 'urn:turn:' || b.conv_id || '-' || b.turn as y
from conversations a join conversations b on a.conv_id = b.conv_id and a.turn < b.turn
where a.role = 'system'
""")
def path_plus_joined(spark, sf_dir):
    """The turns that follow a system turn: walked from those that the role pattern finds."""
    sol = bgp(quads(spark, sf_dir), [("?x", plus(NEXT), "?y"), ("?x", P + "role", lit("system"))], graph=G + "conv")
    return sol.select("x", "y")


@query("""
select 'urn:turn:' || a.conv_id || '-' || a.turn as x, 'urn:turn:' || b.conv_id || '-' || b.turn as y
from conversations a join conversations b on a.conv_id = b.conv_id and a.turn < b.turn
where a.role = 'system' and b.role = 'assistant'
""")
def path_plus_between(spark, sf_dir):
    """From the system turns to the assistant's: both ends come from other patterns, the side that reaches less is walked to its end."""
    patterns = [("?x", plus(NEXT), "?y"), ("?x", P + "role", lit("system")), ("?y", P + "role", lit("assistant"))]
    return bgp(quads(spark, sf_dir), patterns, graph=G + "conv").select("x", "y")


@query("""
select 'urn:turn:' || a.conv_id || '-' || a.turn as x, 'urn:turn:' || b.conv_id || '-' || b.turn as y
from conversations a join conversations b on a.conv_id = b.conv_id and a.turn < b.turn where b.turn = 2
""")
def path_plus_to_seeds(spark, sf_dir):
    """What leads to the third turns, which a path before found: walked against the direction of the path."""
    q = quads(spark, sf_dir)
    ends = pattern(q, "?y", inverse(NEXT), "?before", graph=G + "conv").filter(F.col("y").endswith("-2")).project("y")
    steps = pattern(q, "?x", NEXT, "?y", graph=G + "conv").select("x", "y")
    back = reachable(steps.select(F.col("y").alias("x"), F.col("x").alias("y")), ends.df.select(F.col("y").alias("x")))
    return back.select(F.col("y").alias("x"), F.col("x").alias("y"))

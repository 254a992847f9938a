"""Registered queries: graph patterns, joins, filters, datasets, algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import with_values
from quadloom.operators import paths
from quadloom.operators.forms import instantiate
from quadloom.operators.patterns import (
    bgp, equals, greater_than, iri_in, less_than, not_equals, num, pattern, ts, values, var,
)
from quadloom.operators.solutions import Solutions
from quadloom.operators.updates import distinct_quads
from quadloom.plans.mapping import CLASS, G, P, quads, table
from quadloom.plans.registry import query, time_text


@query("""
select 'urn:customer:' || c_custkey as customer, c_name as name, n_name as nation, r_name as region
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def bgp_chain_customer_region(spark, sf_dir):
    """Customers with the names of their nation and region."""
    q = quads(spark, sf_dir)
    customers = bgp(q, [("?customer", P + "name", "?name"), ("?customer", P + "inNation", "?n")], graph=G + "customer")
    places = bgp(
        q,
        [("?n", P + "name", "?nation"), ("?n", P + "inRegion", "?r"), ("?r", P + "name", "?region")],
        from_=[None],
    )
    return customers.join(places).select("customer", "name", "nation", "region")


@query("""
select 'urn:part:' || p_partkey as part, p_name as name, p_brand as brand, p_size::double as size, p_retailprice as price
from part
""")
def bgp_star(spark, sf_dir):
    q = quads(spark, sf_dir)
    props = ("name", "brand", "size", "price")
    star = bgp(q, [("?part", P + p, f"?{p}") for p in props], graph=G + "part")
    return star.select("part", "name", "brand", size=num("size"), price=num("price"))


@query("""
select 'urn:customer:' || c_custkey as c, 'urn:supplier:' || s_suppkey as s
from customer join supplier on c_nationkey = s_nationkey
""")
def bgp_shared_object(spark, sf_dir):
    """Two patterns joined on their objects, by term identity."""
    q = quads(spark, sf_dir)
    left = pattern(q, "?c", P + "inNation", "?n", graph=G + "customer")
    return left.join(pattern(q, "?s", P + "inNation", "?n", graph=G + "supplier"), shares=32).select("c", "s")


@query("""
select 'urn:order:' || o_orderkey as o, 'urn:part:' || l_partkey as part, n_name as nation
from (select distinct l_orderkey, l_partkey from lineitem)
join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
""")
def bgp_order_parts_nation(spark, sf_dir):
    """A long chain over the largest tables, ending at a small one."""
    q = quads(spark, sf_dir)
    bought = pattern(q, "?o", P + "hasPart", "?part", graph=G + "lineitem")
    placed = pattern(q, "?o", P + "placedBy", "?c", graph=G + "orders")
    living = pattern(q, "?c", P + "inNation", "?n", graph=G + "customer")
    named = pattern(q, "?n", P + "name", "?nation", from_=[None])
    return bought.join(placed).join(living.join(named)).select("o", "part", "nation")


@query("select 'urn:nation:' || n_nationkey as x from nation where (n_nationkey + 1) % 25 = n_nationkey")
def bgp_repeated_var(spark, sf_dir):
    """?x next ?x: no nation follows itself."""
    return pattern(quads(spark, sf_dir), "?x", P + "next", "?x").select("x")


@query("""
select 'urn:supplier:' || s_suppkey as s, s_name as name, r_name as region from supplier, region
where exists (select 1 from nation where n_nationkey = 3 and n_regionkey = 3)
""")
def bgp_unrelated_patterns(spark, sf_dir):
    """Patterns without a shared variable: a ground one is a test, a small one is carried along."""
    q = quads(spark, sf_dir)
    suppliers = bgp(
        q,
        [("?s", P + "name", "?name"), ("urn:nation:3", P + "inRegion", "urn:region:3")],
        from_=[G + "supplier", None],
    ).filter(var("s").startswith("urn:supplier:"))
    regions = pattern(q, "?r", P + "name", "?region", from_=[None]).filter(var("r").startswith("urn:region:"))
    return suppliers.join(regions).select("s", "name", "region")


@query("""
select 'urn:customer:' || c_custkey as c, c_name as name, case when c_acctbal > 5000 then 'true' end as vip
from customer
""")
def optional_vip(spark, sf_dir):
    q = quads(spark, sf_dir)
    base = pattern(q, "?c", P + "name", "?name", graph=G + "customer")
    return base.optional(pattern(q, "?c", P + "vip", "?vip", graph=G + "customer")).select("c", "name", "vip")


@query("""
select 'urn:customer:' || c_custkey as c, 'urn:order:' || o_orderkey as o, o_totalprice as total
from customer left join orders on o_custkey = c_custkey and o_totalprice > 400000
""")
def optional_orders_with_filter(spark, sf_dir):
    """A FILTER inside the OPTIONAL part belongs to the join condition."""
    q = quads(spark, sf_dir)
    base = pattern(q, "?c", P + "name", "?name", graph=G + "customer")
    orders = bgp(q, [("?o", P + "placedBy", "?c"), ("?o", P + "total", "?total")], graph=G + "orders")
    return base.optional(orders, condition=num("total") > 400000).select("c", "o", total=num("total"))


@query("""
with left_part as (
  select c_custkey, c_nationkey, case when c_acctbal > 5000 then 'true' end as flag from customer)
select 'urn:customer:' || l.c_custkey as c, coalesce(l.flag, v.flag) as flag, v.label
from left_part l join (values ('true', 'rich'), ('false', 'other')) v(flag, label)
on l.flag is null or l.flag = v.flag
""")
def optional_then_join(spark, sf_dir):
    """A variable that may be unbound is shared later: unbound matches everything."""
    q = quads(spark, sf_dir)
    base = pattern(q, "?c", P + "name", "?name", graph=G + "customer")
    flagged = base.optional(pattern(q, "?c", P + "vip", "?flag", graph=G + "customer"))
    labels = values(spark, ["flag", "label"], [[lit("true"), lit("rich")], [lit("false"), lit("other")]])
    return flagged.join(labels).select("c", "flag", "label")


@query("""
select 'urn:customer:' || c_custkey as c from customer
where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'O')
""")
def exists_customers_with_open_orders(spark, sf_dir):
    q = quads(spark, sf_dir)
    customers = pattern(q, "?c", P + "name", "?name", graph=G + "customer").project("c")
    open_orders = bgp(q, [("?o", P + "placedBy", "?c"), ("?o", P + "status", lit("O"))], graph=G + "orders")
    return customers.exists(open_orders).select("c")


@query("""
select 'urn:customer:' || c_custkey as c from customer
where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'O' and o_orderpriority = '1-URGENT')
""")
def not_exists_customers_without_urgent_open_order(spark, sf_dir):
    q = quads(spark, sf_dir)
    customers = pattern(q, "?c", P + "name", "?name", graph=G + "customer").project("c")
    urgent = bgp(
        q,
        [("?o", P + "placedBy", "?c"), ("?o", P + "status", lit("O")), ("?o", P + "priority", lit("1-URGENT"))],
        graph=G + "orders",
    )
    return customers.not_exists(urgent).select("c")


@query("select 'urn:part:' || p_partkey as part from part where p_size = 15 and p_brand = 'Brand#7'")
def filter_eq(spark, sf_dir):
    """Equality by value for numbers, by term for strings."""
    q = quads(spark, sf_dir)
    sol = bgp(q, [("?part", P + "size", "?size"), ("?part", P + "brand", "?brand")], graph=G + "part")
    return sol.filter(equals("size", 15)).filter(equals("brand", lit("Brand#7"))).select("part")


@query("select 'urn:supplier:' || s_suppkey as s, 'urn:nation:' || s_nationkey as n from supplier where s_nationkey <> 3")
def filter_ne(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?s", P + "inNation", "?n", graph=G + "supplier")
    return sol.filter(not_equals("n", "urn:nation:3")).select("s", "n")


@query("""
select 'urn:customer:' || c_custkey as c, c_acctbal as balance from customer
where c_acctbal >= 1000 and c_acctbal < 2000
""")
def filter_numeric_range(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?c", P + "acctbal", "?b", graph=G + "customer")
    return sol.filter((num("b") >= 1000) & (num("b") < 2000)).select("c", balance=num("b"))


@query("""
select 'urn:order:' || o_orderkey as o, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as placed from orders
where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1996-04-01'
""")
def filter_date_range(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?o", P + "date", "?d", graph=G + "orders")
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("1996-01-01 00:00:00", "1996-04-01 00:00:00"))
    return sol.filter((ts("d") >= low) & (ts("d") < high)).select("o", placed=time_text(ts("d")))


@query("""
select 'urn:customer:' || c_custkey as c, 'urn:nation:' || c_nationkey as n from customer
where c_nationkey in (1, 2, 24)
""")
def filter_in_list(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?c", P + "inNation", "?n", graph=G + "customer")
    return sol.filter(iri_in("n", ["urn:nation:1", "urn:nation:2", "urn:nation:24"])).select("c", "n")


@query("select 'urn:customer:' || c_custkey as c, c_mktsegment as segment from customer where c_acctbal > 5000")
def graph_const(spark, sf_dir):
    return pattern(quads(spark, sf_dir), "?c", P + "segment", "?segment", graph=G + "vip").select("c", "segment")


@query("""
with m as (
  select 'urn:g:customer' as g, c_custkey, c_name, c_mktsegment from customer
  union all select 'urn:g:vip', c_custkey, c_name, c_mktsegment from customer where c_acctbal > 5000)
select g, 'urn:customer:' || c_custkey as c, c_name as name, c_mktsegment as segment from m
""")
def graph_var_same_graph(spark, sf_dir):
    """GRAPH ?g: all patterns inside match in the same graph."""
    sol = bgp(quads(spark, sf_dir), [("?c", P + "name", "?name"), ("?c", P + "segment", "?segment")], graph="?g")
    return sol.select("g", "c", "name", "segment")


@query("""
select 'urn:customer:' || c_custkey as x, c_name as name from customer
union select 'urn:supplier:' || s_suppkey, s_name from supplier
""")
def from_union_distinct(spark, sf_dir):
    """FROM several graphs: a triple in two of them counts once."""
    graphs = [G + "customer", G + "vip", G + "supplier"]
    return pattern(quads(spark, sf_dir), "?x", P + "name", "?name", from_=graphs).select("x", "name")


@query("""
select 'urn:g:vip' as g, 'urn:customer:' || c_custkey as x, c_acctbal as balance from customer where c_acctbal > 5000
union all select 'urn:g:supplier', 'urn:supplier:' || s_suppkey, s_acctbal from supplier
""")
def from_named(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?x", P + "acctbal", "?b", graph="?g", from_named=[G + "vip", G + "supplier"])
    return sol.select("g", "x", balance=num("b"))


@query("""
select 'urn:customer:' || c_custkey as x, c_acctbal as balance from customer
union select 'urn:supplier:' || s_suppkey, s_acctbal from supplier
""")
def no_dataset_all_graphs(spark, sf_dir):
    """No dataset clause: every graph, merged as a set."""
    return pattern(quads(spark, sf_dir), "?x", P + "acctbal", "?b").select("x", balance=num("b"))


@query("""
select 'urn:customer:' || c_custkey as c, c_mktsegment as segment, v.label
from customer join (values ('BUILDING', 'b'), ('MACHINERY', 'm')) v(segment, label) on c_mktsegment = v.segment
""")
def values_join(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?c", P + "segment", "?segment", graph=G + "customer")
    table = values(spark, ["?segment", "?label"], [[lit("BUILDING"), lit("b")], [lit("MACHINERY"), lit("m")]])
    return sol.join(table).select("c", "segment", "label")


@query("""
select 'urn:order:' || o_orderkey as o, 'urn:customer:' || o_custkey as c, o_orderstatus as status, o_totalprice as total
from orders where o_orderstatus = 'F'
""")
def bindings_equality(spark, sf_dir):
    """A bound variable restricts the match and stays in the result; unused names do nothing."""
    sol = bgp(
        quads(spark, sf_dir),
        [("?o", P + "status", "?status"), ("?o", P + "placedBy", "?c"), ("?o", P + "total", "?total")],
        graph=G + "orders",
        bindings={"status": lit("F"), "unused": "urn:nothing"},
    )
    return sol.select("o", "c", "status", total=num("total"))


@query("""
select 'urn:customer:' || c_custkey as x, c_name as customer, null::varchar as supplier from customer
union all select 'urn:supplier:' || s_suppkey, null, s_name from supplier
""")
def union_patterns(spark, sf_dir):
    q = quads(spark, sf_dir)
    left = pattern(q, "?x", P + "name", "?customer", graph=G + "customer")
    return left.union(pattern(q, "?x", P + "name", "?supplier", graph=G + "supplier")).select("x", "customer", "supplier")


@query("select 'urn:customer:' || c_custkey as c from customer where not (c_acctbal > 5000)")
def minus_patterns(spark, sf_dir):
    q = quads(spark, sf_dir)
    base = pattern(q, "?c", P + "name", "?name", graph=G + "customer")
    return base.minus(pattern(q, "?c", P + "vip", "?v", graph=G + "customer")).select("c")


@query("""
select 'urn:customer:' || c_custkey as c, c_name as name, n from customer
join (select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 12) on o_custkey = c_custkey
""")
def subselect(spark, sf_dir):
    """A grouped sub-SELECT joined with an outer pattern."""
    q = quads(spark, sf_dir)
    counted = pattern(q, "?o", P + "placedBy", "?c", graph=G + "orders").df.groupBy("c").agg(F.count("o").alias("n"))
    busy = Solutions(counted.where("n > 12"), ("c", "n"))
    return pattern(q, "?c", P + "name", "?name", graph=G + "customer").join(busy).select("c", "name", "n")


@query("""
select 'urn:part:' || p_partkey as part, case when p_size > 25 then 'large' else 'small' end as label,
round(p_retailprice * p_size, 2) as stock from part
""")
def bind_expr(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?part", P + "size", "?size"), ("?part", P + "price", "?price")], graph=G + "part")
    bound = sol.bind("label", F.when(num("size") > 25, "large").otherwise("small"), dt="urn:label")
    return bound.select("part", "label", stock=F.round(num("price") * num("size"), 2))


@query("""
select 'urn:order:' || o_orderkey as o, 'urn:customer:' || o_custkey as c, c_name as name,
c_mktsegment as segment from orders join customer on o_custkey = c_custkey
""")
def join_spread_hot_keys(spark, sf_dir):
    """A customer with very many orders is split over several tasks."""
    q = quads(spark, sf_dir)
    orders = pattern(q, "?o", P + "placedBy", "?c", graph=G + "orders")
    customers = bgp(q, [("?c", P + "name", "?name"), ("?c", P + "segment", "?segment")], graph=G + "customer")
    return orders.join(customers, spread=16).select("o", "c", "name", "segment")


@query("""
select n_name as nation, 'urn:customer:' || c_custkey as c from nation left join customer
on c_nationkey = n_nationkey and c_acctbal > 9500
""")
def optional_spread_hot_keys(spark, sf_dir):
    q = quads(spark, sf_dir)
    nations = pattern(q, "?n", P + "name", "?nation", from_=[None]).filter(var("n").startswith("urn:nation:"))
    rich = bgp(q, [("?c", P + "inNation", "?n"), ("?c", P + "acctbal", "?b")], graph=G + "customer")
    return nations.optional(rich.filter(num("b") > 9500), spread=16).select("nation", "c")


@query("""
select 'urn:customer:' || c_custkey as c, n_name as nation
from customer join nation on c_nationkey = n_nationkey where c_mktsegment = 'BUILDING'
""")
def bgp_relative_iris(spark, sf_dir):
    """Relative IRIs in patterns, paths and graphs are resolved against the base of the query."""
    q = quads(spark, sf_dir)
    base = "http://example.org/shop/terms#all"
    facts = bgp(
        q, [("?c", P + "segment", "?seg"), ("?c", P + "inNation", "?n"), ("?n", P + "name", "?name")],
        from_=[G + "customer", None],
    )
    templates = [("?c", "#segment", "?seg"), ("?c", "#in", "?n"), ("?n", "../name", "?name")]
    shop = distinct_quads(instantiate(facts, templates, "graphs/one", base))
    sol = bgp(
        shop,
        [("?c", "http://example.org/shop/terms#segment", lit("BUILDING")), ("?c", paths.seq("#in", "/name"), "?nation")],
        graph="/shop/graphs/./one",
        base=base,
    )
    return sol.select("c", "nation")


def _big_numbers(spark, sf_dir):
    """Order numbers beyond 2^53, where neighbours are one double."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    rows = orders.select(
        F.lit(G + "big").alias("g"),
        F.concat(F.lit("urn:order:"), F.col("o_orderkey").cast("string")).alias("s"),
        F.lit(P + "number").alias("p"),
        (F.lit(2**53) + F.col("o_orderkey")).cast("string").alias("o"),
        F.lit("lit").alias("o_kind"),
        F.lit(V.XSD_INTEGER).alias("o_dt"),
        *[F.lit(None).cast("string").alias(c) for c in ("o_lang", "doc_id")],
    )
    return pattern(with_values(rows), "?s", P + "number", "?n", graph=G + "big")


@query("""
select 'urn:order:' || o_orderkey as s, o_orderkey = 33 as same, o_orderkey <> 33 as other, o_orderkey < 33 as less, o_orderkey > 33 as more
from orders
""")
def filter_eq_big_integer(spark, sf_dir):
    """Integers compare by all their digits."""
    number, sol = 2**53 + 33, _big_numbers(spark, sf_dir)
    return sol.select(
        "s", same=equals("n", number), other=not_equals("n", number),
        less=less_than("n", number), more=greater_than("n", number),
    )


@query("""
select 'urn:part:' || p_partkey as part, p_size::varchar as v from part where p_size <> 15
union all select 'urn:part:' || p_partkey, 'urn:class:' || p_type from part
""")
def filter_ne_mixed(spark, sf_dir):
    """An IRI differs from any number, so it passes the test."""
    sol = pattern(quads(spark, sf_dir), "?part", paths.alt(P + "size", "a"), "?v", graph=G + "part")
    return sol.filter(not_equals("v", 15)).select("part", "v")


@query("""
select p.p_partkey as part, v.label as label from part p join
(values (1, 'PROMO', 'Brand#12', null), (2, null, null, 10), (3, 'SMALL', null, 20), (4, null, 'Brand#34', 30), (5, null, null, null)) v(label, kind, brand, size)
on (v.kind is null or p.p_retailprice <= 1000 or v.kind = p.p_type) and (v.brand is null or p.p_size <= 20 or v.brand = p.p_brand)
and (v.size is null or p.p_partkey % 2 = 0 or v.size = p.p_size)
""")
def optional_three_open_joined(spark, sf_dir):
    """Three variables that either side may leave unbound: one join by what both bind, one for rows with nothing in common."""
    q = quads(spark, sf_dir)
    g = G + "part"
    base = pattern(q, "?part", P + "name", "?name", graph=g).project("part")
    dear = bgp(q, [("?part", P + "price", "?price"), ("?part", V.RDF_TYPE, "?kind")], graph=g).filter(num("price") > 1000)
    large = bgp(q, [("?part", P + "size", "?s"), ("?part", P + "brand", "?brand")], graph=g).filter(num("s") > 20)
    odd = pattern(q, "?part", P + "size", "?size", graph=g).filter(F.regexp_extract("part", "([0-9]+)$", 1).cast("long") % 2 == 1)
    parts = base.optional(dear.project("part", "kind")).optional(large.project("part", "brand")).optional(odd)
    rows = [
        [lit(1), CLASS + "PROMO", lit("Brand#12"), None], [lit(2), None, None, lit(10)], [lit(3), CLASS + "SMALL", None, lit(20)],
        [lit(4), None, lit("Brand#34"), lit(30)], [lit(5), None, None, None],
    ]
    wanted = values(spark, ["label", "kind", "brand", "size"], rows)
    found = parts.join(wanted)
    return found.df.select(F.regexp_extract("part", "([0-9]+)$", 1).cast("long").alias("part"), F.col("label").cast("int").alias("label"))


@query("""
select 'urn:customer:' || c_custkey as c, o.o as o from customer
left join (select o_custkey % 3 as k, 'urn:order:' || o_orderkey as o from orders where o_custkey % 3 = 1 and o_totalprice > 100000
union all select 50, 'urn:order:' || o_orderkey from orders where o_orderkey % 100 = 0) o on o.k = c_custkey and c_acctbal > 0
""")
def optional_hot_right(spark, sf_dir):
    """An optional part where nearly all rows have one key: customers keep their row where the filter leaves them nothing."""
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_custkey % 3 = 1 and o_totalprice > 100000").select(F.lit("urn:customer:1").alias("c"), F.concat(F.lit("urn:order:"), "o_orderkey").alias("o"))
    second = orders.where("o_orderkey % 100 = 0").select(F.lit("urn:customer:50"), F.concat(F.lit("urn:order:"), "o_orderkey"))
    part = Solutions(first.union(second), ("c", "o"))
    customers = pattern(quads(spark, sf_dir), "?c", P + "acctbal", "?b", graph=G + "customer")
    return customers.optional(part, num("b") > 0, spread=16).select("c", "o")

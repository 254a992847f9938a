"""Registered queries: query forms, solution modifiers and aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.operators import aggregates as A
from quadloom.operators import forms
from quadloom.operators.patterns import bgp, num, pattern, values
from quadloom.operators.exact_sums import exact_sums
from quadloom.operators.solutions import Solutions
from quadloom.plans.mapping import CLASS, G, P, quads, table
from quadloom.plans.registry import plain, quads_sql, query, time_text


@query("""
select 'urn:region:' || r_regionkey as s, 'urn:p:name' as p, r_name as o from region
union all select 'urn:nation:' || n_nationkey, 'urn:p:name', n_name from nation
union all select 'urn:nation:' || n_nationkey, 'urn:p:inRegion', 'urn:region:' || n_regionkey from nation
union all select 'urn:nation:' || n_nationkey, 'urn:p:next', 'urn:nation:' || ((n_nationkey + 1) % 25) from nation
""")
def select_star(spark, sf_dir):
    return pattern(quads(spark, sf_dir), "?s", "?p", "?o", from_=[None]).select("s", "p", "o")


@query("select count(*) > 0 as result from supplier where s_nationkey = 3")
def ask_true(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?s", P + "inNation", "urn:nation:3")], graph=G + "supplier")
    return forms.ask(sol)


@query("select count(*) > 0 as result from part where p_type = 'NO SUCH TYPE'")
def ask_false(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?p", "a", CLASS + "NO SUCH TYPE")], graph=G + "part")
    return forms.ask(sol)


@query("""
select 'urn:nation:' || c_nationkey as s, 'urn:p:hasCustomer' as p, 'urn:customer:' || c_custkey as o,
'iri' as o_kind from customer
union select 'urn:nation:' || c_nationkey, 'urn:p:segment', c_mktsegment, 'lit' from customer
union select 'urn:nation:' || c_nationkey, 'urn:p:kind', 'nation', 'lit' from customer
""")
def construct_template(spark, sf_dir):
    """Three templates, one with constants; the result is a set."""
    sol = bgp(quads(spark, sf_dir), [("?c", P + "inNation", "?n"), ("?c", P + "segment", "?seg")], graph=G + "customer")
    triples = forms.construct(
        sol,
        [
            ("?n", P + "hasCustomer", "?c"),
            ("?n", P + "segment", "?seg"),
            ("?n", P + "kind", lit("nation")),
        ],
    )
    return triples.select("s", "p", "o", "o_kind")


@query("""
select 'urn:customer:' || c_custkey as s, 'urn:p:label' as p, 'true' as o from customer where c_acctbal > 5000
""")
def construct_unbound_skipped(spark, sf_dir):
    """Solutions with an unbound template slot give no triple."""
    q = quads(spark, sf_dir)
    base = pattern(q, "?c", P + "name", "?name", graph=G + "customer")
    sol = base.optional(pattern(q, "?c", P + "vip", "?v", graph=G + "customer"))
    return forms.construct(sol, [("?c", P + "label", "?v")]).select("s", "p", "o")


@query(quads_sql("customer", "vip", "part") + """
select distinct s, p, o_text, o_kind, o_num, o_time from q where s in ('urn:customer:10', 'urn:part:3')
""")
def describe_resource(spark, sf_dir):
    return plain(forms.describe(quads(spark, sf_dir), "urn:customer:10", "urn:part:3"))


@query("select distinct p_brand as brand, p_type as type from part")
def select_distinct(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?p", P + "brand", "?brand"), ("?p", "a", "?type")], graph=G + "part")
    kept = sol.project("brand", "type").distinct()
    return kept.select("brand", type=F.expr(f"substring(type, {len(CLASS) + 1})"))


@query("""
select c_mktsegment as segment, c_name as name, row_number() over (order by c_mktsegment, c_name desc) as place
from customer
""")
def order_by_two_keys(spark, sf_dir):
    """One key up, one down; the place in the order is compared as well."""
    sol = bgp(quads(spark, sf_dir), [("?c", P + "segment", "?segment"), ("?c", P + "name", "?name")], graph=G + "customer")
    keys = forms.sort_columns(sol, ["segment", "-name"])
    return forms.with_positions(sol.df.select(*sol.columns_of("segment"), *sol.columns_of("name")), keys, "place").select(
        "segment", "name", "place"
    )


@query("""
select 'urn:order:' || o_orderkey as o, o_totalprice as total from orders
order by o_totalprice desc, 'urn:order:' || o_orderkey desc limit 20
""")
def limit_topk(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?o", P + "total", "?t", graph=G + "orders")
    return forms.limit(forms.order_by(sol, "-t", "-o"), 20).select("o", total=num("t"))


_PARTS = "select p_name as name, 'urn:part:' || p_partkey as part from part order by 1, 2"


@query(_PARTS + " limit 10 offset 50")
def page_middle(spark, sf_dir):
    """Rows 51 to 60; pages count from 1."""
    return _page(spark, sf_dir, 51, 10)


@query(_PARTS + " limit 10 offset (select count(*) - 4 from part)")
def page_past_end(spark, sf_dir):
    """The last page is short."""
    total = pattern(quads(spark, sf_dir), "?part", P + "name", "?name", graph=G + "part").df.count()
    return _page(spark, sf_dir, total - 3, 10)


@query(_PARTS + " offset 100")
def page_unlimited(spark, sf_dir):
    """A length of 0 means everything from the start row on."""
    return _page(spark, sf_dir, 101, 0)


def _page(spark, sf_dir, start, length):
    sol = pattern(quads(spark, sf_dir), "?part", P + "name", "?name", graph=G + "part")
    return forms.page(sol.df, forms.sort_columns(sol, ["name", "part"]), start, length).select("name", "part")


@query("select c_name as name from customer where false")
def empty_result(spark, sf_dir):
    return pattern(quads(spark, sf_dir), "urn:customer:999999999999", P + "name", "?name").select("name")


# -- aggregation -----------------------------------------------------------------


@query("""
select count(*) as customers, count(case when c_acctbal > 5000 then 1 end) as vips from customer
""")
def count_bound(spark, sf_dir):
    q = quads(spark, sf_dir)
    base = pattern(q, "?c", P + "name", "?name", graph=G + "customer")
    sol = base.optional(pattern(q, "?c", P + "vip", "?v", graph=G + "customer"))
    return A.group(sol, customers=A.count(), vips=A.count("v"))


@query("select count(*) as n, sum(x)::double as total from (select 0 as x where false)")
def count_nothing(spark, sf_dir):
    """Without groups there is one row, also for no solutions."""
    sol = pattern(quads(spark, sf_dir), "urn:customer:999999999999", P + "acctbal", "?b")
    return A.group(sol, n=A.count("b"), total=A.max_num("b"))


@query("""
select o_orderstatus as status, count(distinct o_custkey) as customers, count(distinct o_orderpriority) as priorities
from orders group by 1
""")
def count_distinct(spark, sf_dir):
    sol = bgp(
        quads(spark, sf_dir),
        [("?o", P + "status", "?status"), ("?o", P + "placedBy", "?c"), ("?o", P + "priority", "?pr")],
        graph=G + "orders",
    )
    return A.group(sol, ["status"], customers=A.count_distinct(sol, "c"), priorities=A.count_distinct(sol, "pr"))


@query("""
select 'urn:customer:' || o_custkey as c, count(*) as n, round(sum(o_totalprice), 2) as total
from orders group by 1 having sum(o_totalprice) > 3000000
""")
def group_sum_having(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?o", P + "placedBy", "?c"), ("?o", P + "total", "?t")], graph=G + "orders")
    grouped = A.group(sol, ["c"], n=A.count(), total=A.sum_("t")).where("total > 3000000")
    return grouped.withColumn("total", F.round("total", 2))


@query("""
select p_brand as brand, round(avg(p_retailprice), 4) as mean, min(p_size)::double as smallest,
max(p_size)::double as largest, min(p_name) as first_name, max(p_name) as last_name, min(p_name) as some
from part group by p_brand
""")
def group_avg_min_max(spark, sf_dir):
    sol = bgp(
        quads(spark, sf_dir),
        [("?p", P + "brand", "?brand"), ("?p", P + "price", "?price"), ("?p", P + "size", "?size"), ("?p", P + "name", "?name")],
        graph=G + "part",
    )
    grouped = A.group(
        sol,
        ["brand"],
        mean=A.avg("price"),
        smallest=A.min_num("size"),
        largest=A.max_num("size"),
        first_name=A.min_str("name"),
        last_name=A.max_str("name"),
        some=A.sample("name"),
    )
    return grouped.withColumn("mean", F.round("mean", 4))


@query("""
select o_orderstatus as status, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') as first_day,
strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as last_day from orders group by 1
""")
def group_min_max_time(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?o", P + "status", "?status"), ("?o", P + "date", "?d")], graph=G + "orders")
    grouped = A.group(sol, ["status"], first_day=A.min_time("d"), last_day=A.max_time("d"))
    return grouped.select("status", *[time_text(F.col(c)).alias(c) for c in ("first_day", "last_day")])


@query("""
select p_brand as brand, case when true then null end::double as total, count(*) as n from part group by p_brand
""")
def group_sum_error(spark, sf_dir):
    """Summing texts is an error: the sum stays unbound, the group remains."""
    sol = bgp(quads(spark, sf_dir), [("?p", P + "brand", "?brand"), ("?p", P + "name", "?name")], graph=G + "part")
    return A.group(sol, ["brand"], total=A.sum_("name"), n=A.count())


@query("""
select o_orderpriority as priority, string_agg(distinct o_orderstatus, ', ' order by o_orderstatus) as statuses
from orders group by 1
""")
def group_concat(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?o", P + "priority", "?priority"), ("?o", P + "status", "?status")], graph=G + "orders")
    return A.group_concat(sol, ["priority"], "status", "statuses", ", ", distinct=True)


@query("""
with x as (select l_returnflag as flag, cast(l_extendedprice as decimal(18,2)) as price, cast(l_quantity as bigint) as quantity from lineitem)
select flag, regexp_replace(sum(price)::varchar, '[.]?0+$', '') as total, 'http://www.w3.org/2001/XMLSchema#decimal' as total_type,
sum(quantity)::varchar as units, 'http://www.w3.org/2001/XMLSchema#integer' as units_type,
min(price)::varchar as cheapest, max(price)::varchar as dearest from x group by flag
""")
def group_sum_exact(spark, sf_dir):
    """Decimals and integers add up exactly and keep their type; the least and the greatest are whole terms."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.col("l_quantity").cast("long").cast("string").alias("quantity"),
    )
    sol = Solutions(lines, ("flag",))
    sol = sol.bind("p", F.col("price"), V.XSD_DECIMAL).bind("u", F.col("quantity"), V.XSD_INTEGER)
    grouped = A.group(
        sol, ["flag"], total=A.sum_term("p"), units=A.sum_term("u"), least=A.min_term("p"), most=A.max_term("p")
    )
    return grouped.select(
        "flag", F.col("total.o").alias("total"), F.col("total.o_dt").alias("total_type"),
        F.col("units.o").alias("units"), F.col("units.o_dt").alias("units_type"),
        F.col("least.o").alias("cheapest"), F.col("most.o").alias("dearest"),
    )


@query("""
with x as (
  select l_returnflag as flag, cast(l_orderkey as hugeint) * cast('100000000000000000000000000000' as hugeint) + l_partkey as low,
         cast(l_extendedprice as decimal(18, 2)) as price, case when l_linenumber % 2 = 0 then -1 else 1 end as sign
  from lineitem)
select flag, count(*) as n, (sum(sign * low))::varchar as total, 'http://www.w3.org/2001/XMLSchema#integer' as total_type,
       sum(sign * price)::varchar as price
from x group by flag
""")
def group_sum_limbs(spark, sf_dir):
    """Integers of 35 digits behind zeros, positive and negative ones, and decimals add up exactly."""
    lines = table(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("")
    low = F.lpad(F.col("l_partkey").cast("string"), 29, "0")
    numbers = lines.select(
        F.col("l_returnflag").alias("flag"),
        # zeros in front change nothing
        F.concat(sign, F.lit("0" * 20), F.col("l_orderkey").cast("string"), low).alias("long"),
        F.concat(sign, F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("price"),
    )
    sol = Solutions(numbers, ("flag",)).bind("x", F.col("long"), V.XSD_INTEGER).bind("p", F.col("price"), V.XSD_DECIMAL)
    longs = exact_sums(sol, ["flag"], "x").select("flag", "n", F.col("sum").alias("total"), F.col("sum_dt").alias("total_type"))
    prices = exact_sums(sol, ["flag"], "p").select(F.col("flag").alias("_flag"), F.col("sum").try_cast("decimal(38,2)").cast("string").alias("price"))
    return longs.join(prices, F.col("flag") == F.col("_flag")).drop("_flag")


@query("""
select l_returnflag as flag, trunc((sum(l_quantity)::hugeint * 1000000)::decimal(38, 0) / count(*)) / 1000000 as mean from lineitem group by l_returnflag
""")
def group_avg_exact(spark, sf_dir):
    """Averages from exact sums, compared to six places."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("long").cast("string").alias("q"))
    sol = Solutions(lines, ("flag",)).bind("x", F.col("q"), V.XSD_INTEGER)
    six = F.regexp_extract("avg", r"^-?[0-9]+(\.[0-9]{1,6})?", 0)
    return exact_sums(sol, ["flag"], "x").select("flag", six.cast("double").alias("mean"))


@query("""
select 'urn:customer:' || c_custkey as c, c_name as name from customer order by c_name, c_custkey limit 40 offset 25
""")
def offset_limit(spark, sf_dir):
    """OFFSET and LIMIT in the order of a name."""
    sol = pattern(quads(spark, sf_dir), "?c", P + "name", "?name", graph=G + "customer")
    return forms.slice_(sol.select("c", "name"), [F.col("name").asc(), F.col("c").asc()], 25, 40)


@query("""
select 'urn:customer:' || c_custkey as c, c_mktsegment as segment from customer where c_custkey in (1, 2, 3)
""")
def values_relative_iris(spark, sf_dir):
    """Relative IRIs of inline data are resolved against the base."""
    wanted = values(spark, ["c"], [["customers/1"], ["customers/2"], ["../shop/customers/3"]], base="http://example.org/shop/data")
    keys = wanted.df.withColumn("c", F.regexp_replace("c", "^http://example.org/shop/customers/", "urn:customer:"))
    sol = pattern(quads(spark, sf_dir), "?c", P + "segment", "?segment", graph=G + "customer")
    return Solutions(keys.select("c"), ("c",)).join(sol).select("c", "segment")

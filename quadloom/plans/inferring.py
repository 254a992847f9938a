"""Registered queries: rule-based inference."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quadloom import iri, lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import statements, with_values
from quadloom.operators import inference as I
from quadloom.operators.scan import count_per_graph
from quadloom.plans.mapping import CLASS, G, P, quads, schema_rows, table
from quadloom.plans.registry import query

_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"

# class -> its superclasses, written out
_SUPERS = """(values ('PROMO','ECONOMY'),('PROMO','CATALOG'),('PROMO','THING'),('ECONOMY','CATALOG'),
('ECONOMY','THING'),('CATALOG','THING'),('SMALL','SIZED'),('SMALL','THING'),('MEDIUM','SIZED'),
('MEDIUM','THING'),('LARGE','SIZED'),('LARGE','THING'),('SIZED','THING'),('STANDARD','THING')) t(c, d)"""


def _facts(spark, sf_dir, *graphs, extra=()):
    """Quads of some graphs together with the declarations (default graph)."""
    data = quads(spark, sf_dir).limited(graphs=list(graphs)).df
    return data.union(statements(spark, [*schema_rows(), *extra]))


@query(f"select 'urn:part:' || p_partkey as s, 'urn:class:' || d as o from part join {_SUPERS} on p_type = c")
def infer_subclass(spark, sf_dir):
    new = I.infer(_facts(spark, sf_dir, G + "part"), ["SUBCLASS_OF"])
    return new.where(F.col("p") == V.RDF_TYPE).select("s", "o")


@query(f"""
select 'urn:class:' || c as s, 'urn:class:' || d as o from {_SUPERS}
except select * from (values ('urn:class:PROMO','urn:class:ECONOMY'),('urn:class:ECONOMY','urn:class:CATALOG'),
('urn:class:SMALL','urn:class:SIZED'),('urn:class:MEDIUM','urn:class:SIZED'),('urn:class:LARGE','urn:class:SIZED'),
('urn:class:SIZED','urn:class:THING'),('urn:class:CATALOG','urn:class:THING'),('urn:class:STANDARD','urn:class:THING'))
union all (select 'urn:brand:' || p_brand, 'urn:class:' || d from part join {_SUPERS} on p_type = c
except select 'urn:brand:' || p_brand, 'urn:class:' || p_type from part)
""")
def infer_subclass_declarations(spark, sf_dir):
    """The implied subclass declarations themselves: every brand is declared below the types of its parts."""
    brands = table(spark, sf_dir, "part").select(
        F.lit(V.DEFAULT_GRAPH).alias("g"),
        F.concat(F.lit("urn:brand:"), "p_brand").alias("s"),
        F.lit(V.SUB_CLASS_OF).alias("p"),
        F.concat(F.lit(CLASS), "p_type").alias("o"),
        F.lit("iri").alias("o_kind"),
        *[F.lit(None).cast("string").alias(c) for c in ("o_dt", "o_lang", "doc_id")],
    )
    facts = _facts(spark, sf_dir, G + "part").union(with_values(brands.distinct()))
    new = I.infer(facts, ["RDFS"])
    return new.where(F.col("p") == V.SUB_CLASS_OF).select("s", "o")


@query("""
select 'urn:order:' || o_orderkey as s, 'urn:customer:' || o_custkey as o from orders
union select 'urn:order:' || l_orderkey, 'urn:part:' || l_partkey from lineitem
""")
def infer_subproperty(spark, sf_dir):
    new = I.infer(_facts(spark, sf_dir, G + "orders", G + "lineitem"), ["SUBPROPERTY_OF"])
    return new.where(F.col("p") == P + "relatedTo").select("s", "o")


@query("""
select 'urn:customer:' || c_custkey as s, 'urn:p:locatedIn' as p, 'urn:nation:' || c_nationkey as o from customer
union all select 'urn:supplier:' || s_suppkey, 'urn:p:locatedIn', 'urn:nation:' || s_nationkey from supplier
union all select 'urn:p:locatedIn', 'http://www.w3.org/2002/07/owl#equivalentProperty', 'urn:p:inNation'
""")
def infer_equivalent_property(spark, sf_dir):
    return I.infer(_facts(spark, sf_dir, G + "customer", G + "supplier"), ["EQUIVALENT_PROPERTY"]).select("s", "p", "o")


@query("""
select 'urn:part:' || p_partkey as s, 'urn:class:WARE' as o from part where p_type = 'PROMO'
union select 'urn:part:' || p_partkey, 'urn:class:OFFER' from part where p_type = 'PROMO'
""")
def infer_equivalent_class(spark, sf_dir):
    extra = [
        (CLASS + "WARE", V.EQUIVALENT_CLASS, CLASS + "PROMO"),
        (CLASS + "WARE", V.EQUIVALENT_CLASS, CLASS + "OFFER"),
    ]
    new = I.infer(_facts(spark, sf_dir, G + "part", extra=extra), ["EQUIVALENT_CLASS"])
    return new.where(F.col("p") == V.RDF_TYPE).select("s", "o")


@query("""
select 'urn:order:' || o_orderkey as s, 'urn:class:Order' as o from orders
union select 'urn:customer:' || o_custkey, 'urn:class:Customer' from orders
""")
def infer_domain_range(spark, sf_dir):
    new = I.infer(_facts(spark, sf_dir, G + "orders"), ["DOMAIN", "RANGE"])
    return new.where(F.col("p") == V.RDF_TYPE).select("s", "o")


@query("select 'urn:customer:' || o_custkey as s, 'urn:order:' || o_orderkey as o from orders")
def infer_inverse(spark, sf_dir):
    new = I.infer(_facts(spark, sf_dir, G + "orders"), ["INVERSE_OF"])
    return new.where(F.col("p") == P + "placed").select("s", "o")


@query("""
select 'urn:part:' || p_partkey as s, 'urn:class:Fifteen' as o from part where p_size = 15
""")
def infer_has_value(spark, sf_dir):
    """Parts of size 15 become members of the restriction class."""
    extra = [
        (CLASS + "Fifteen", V.ON_PROPERTY, P + "size"),
        (CLASS + "Fifteen", V.HAS_VALUE, lit(15)),
    ]
    new = I.infer(_facts(spark, sf_dir, G + "part", extra=extra), ["HAS_VALUE"])
    return new.where(F.col("p") == V.RDF_TYPE).select("s", "o")


@query("""
select distinct 'urn:turn:' || b.conv_id || '-' || b.turn as s, 'urn:class:Thread' as o
from conversations a join conversations b on a.conv_id = b.conv_id and b.turn > a.turn
where a.turn = 0
""")
def infer_all_values_from(spark, sf_dir):
    """Everything after the first turn of any conversation belongs to a thread: repeats to a fixpoint."""
    extra = [
        (CLASS + "Thread", V.ON_PROPERTY, P + "next"),
        (CLASS + "Thread", V.ALL_VALUES_FROM, CLASS + "Thread"),
    ]
    first = table(spark, sf_dir, "conversations").where("turn = 0").select(
        F.lit(V.DEFAULT_GRAPH).alias("g"),
        F.concat(F.lit("urn:turn:"), F.col("conv_id").cast("string"), F.lit("-0")).alias("s"),
        F.lit(V.RDF_TYPE).alias("p"),
        F.lit(CLASS + "Thread").alias("o"),
        F.lit("iri").alias("o_kind"),
        *[F.lit(None).cast("string").alias(c) for c in ("o_dt", "o_lang", "doc_id")],
    )
    facts = _facts(spark, sf_dir, G + "conv", extra=extra).union(with_values(first))
    new = I.infer(facts, ["ALL_VALUES_FROM"])
    return new.where(F.col("p") == V.RDF_TYPE).select("s", "o")


@query("""
select 'urn:p:relatedTo' as p, count(*) as n from orders
union all select 'urn:p:placed', count(*) from orders
union all select 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type',
(select count(*) from orders) + (select count(distinct o_custkey) from orders)
""")
def infer_bundle(spark, sf_dir):
    """All rules of a bundle together, counted per predicate."""
    new = I.infer(_facts(spark, sf_dir, G + "orders"), ["RDFS_PLUS"])
    data = new.where(~F.col("p").isin(*I.DECLARING))
    return data.groupBy("p").agg(F.count("s").alias("n"))


@query("""
with c as (select 'urn:g:customer' as g, c_custkey from customer
union all select 'urn:g:vip', c_custkey from customer where c_acctbal > 5000)
select g, 'urn:customer:' || c_custkey as s from c where g = 'urn:g:vip'
""")
def infer_scoped_to_graph(spark, sf_dir):
    """Declarations in one graph infer in that graph only."""
    data = quads(spark, sf_dir).limited(graphs=[G + "customer", G + "vip"]).df
    rule = statements(spark, [(P + "inNation", V.SUB_PROPERTY_OF, iri(P + "livesIn"), G + "vip")])
    new = I.infer(data.union(rule), ["RDFS"], per_graph=True)
    return new.where(F.col("p") == P + "livesIn").select("g", "s")


@query("""
select 'urn:x-default-graph' as g, 14::bigint as n
union all select 'urn:g:supplier', 3 * count(*) from supplier
""")
def infer_switched_off(spark, sf_dir):
    """Without inferred statements the rulesets do not matter."""
    facts = _facts(spark, sf_dir, G + "supplier")
    return count_per_graph(I.with_inferred(facts, ["RDFS_PLUS_FULL"], include_inferred=False))


@query("""
select distinct 'urn:part:' || a.p_partkey as s, 'urn:brand:' || b.p_brand as o
from part a join (select distinct p_type, p_brand from part) b on a.p_type = b.p_type
""")
def infer_declared_by_rule(spark, sf_dir):
    """A property below subClassOf declares: every type of part is a kind of the brands that it is sold under."""
    kinds = table(spark, sf_dir, "part").select(
        F.lit(V.DEFAULT_GRAPH).alias("g"),
        F.concat(F.lit(CLASS), "p_type").alias("s"),
        F.lit(P + "kindOf").alias("p"),
        F.concat(F.lit("urn:brand:"), "p_brand").alias("o"),
        F.lit("iri").alias("o_kind"),
        *[F.lit(None).cast("string").alias(c) for c in ("o_dt", "o_lang", "doc_id")],
    )
    parts = quads(spark, sf_dir).limited(graphs=[G + "part"]).df
    rule = statements(spark, [(P + "kindOf", V.SUB_PROPERTY_OF, iri(V.SUB_CLASS_OF))])
    new = I.infer(parts.union(with_values(kinds.distinct())).union(rule), ["RDFS"])
    return new.where((F.col("p") == V.RDF_TYPE) & F.col("o").startswith("urn:brand:")).select("s", "o")


@query("""
with brands as (select distinct p_brand as brand from part)
select 'urn:part:' || p_partkey as s, 'urn:p:soldAs' || brand as p, p_name as o
from part join brands on brand <> p_brand
union all
select 'urn:p:soldAs' || a.brand, 'http://www.w3.org/2002/07/owl#equivalentProperty', 'urn:p:soldAs' || b.brand
from brands a join brands b on a.brand <> b.brand
except select 'urn:p:soldAs' || brand, 'http://www.w3.org/2002/07/owl#equivalentProperty', 'urn:p:soldAs' || next_brand
from (select brand, lead(brand) over (order by brand) as next_brand from brands) where next_brand is not null
""")
def infer_equivalent_chain(spark, sf_dir):
    """A property per brand, each declared equivalent to the next one only: all of them mean the same."""
    part = table(spark, sf_dir, "part")
    brands = part.select("p_brand").distinct()
    nulls = [F.lit(None).cast("string").alias(c) for c in ("o_dt", "o_lang", "doc_id")]
    links = brands.withColumn("after", F.lead("p_brand").over(Window.orderBy("p_brand"))).where("after is not null")
    links = links.select(
        F.lit(V.DEFAULT_GRAPH).alias("g"), F.concat(F.lit(P + "soldAs"), "p_brand").alias("s"),
        F.lit(V.EQUIVALENT_PROPERTY).alias("p"), F.concat(F.lit(P + "soldAs"), "after").alias("o"),
        F.lit("iri").alias("o_kind"), *nulls,
    )
    sold = part.select(
        F.lit(G + "part").alias("g"), F.concat(F.lit("urn:part:"), F.col("p_partkey").cast("string")).alias("s"),
        F.concat(F.lit(P + "soldAs"), "p_brand").alias("p"), F.col("p_name").alias("o"), F.lit("lit").alias("o_kind"),
        F.lit(V.XSD_STRING).alias("o_dt"), *nulls[1:],
    )
    return I.infer(with_values(links.union(sold)), ["EQUIVALENT_PROPERTY"]).select("s", "p", "o")


@query("""
with kinds as (select p_type as kind, row_number() over (order by p_type) as n from (select distinct p_type from part))
select distinct 'urn:part:' || p_partkey as s, 'urn:class:' || b.kind as o
from part join kinds a on p_type = a.kind join kinds b on a.n % 2 = b.n % 2 and a.kind <> b.kind
""")
def infer_equivalent_class_groups(spark, sf_dir):
    """Types of parts in two groups of equivalent classes, each linked through its members."""
    part = table(spark, sf_dir, "part")
    kinds = part.select("p_type").distinct().withColumn("n", F.row_number().over(Window.orderBy("p_type")))
    links = kinds.withColumn("after", F.lead("p_type", 2).over(Window.orderBy("n"))).where("after is not null")
    links = links.select(
        F.lit(V.DEFAULT_GRAPH).alias("g"), F.concat(F.lit(CLASS), "p_type").alias("s"),
        F.lit(V.EQUIVALENT_CLASS).alias("p"), F.concat(F.lit(CLASS), "after").alias("o"), F.lit("iri").alias("o_kind"),
        *[F.lit(None).cast("string").alias(c) for c in ("o_dt", "o_lang", "doc_id")],
    )
    parts = quads(spark, sf_dir).limited(graphs=[G + "part"]).df
    new = I.infer(parts.union(with_values(links)), ["RDFS_PLUS"])
    return new.where((F.col("p") == V.RDF_TYPE) & F.col("s").startswith("urn:part:")).select("s", "o")


@query(f"""
select 'default' as kind, count(*) as n from part join {_SUPERS} on p_type = c
union all select 'both', (select count(*) from part join {_SUPERS} on p_type = c) + (select count(*) from part where p_size = 15)
union all select 'none', 0
""")
def infer_default_rulesets(spark, sf_dir):
    """Default rulesets hold beside those of a query; nulls among them count for nothing."""
    extra = [(CLASS + "Fifteen", V.ON_PROPERTY, P + "size"), (CLASS + "Fifteen", V.HAS_VALUE, lit(15))]
    facts = _facts(spark, sf_dir, G + "part", extra=extra)
    runs = {"default": ([None], ["SUBCLASS_OF"]), "both": (["HAS_VALUE", None], ["SUBCLASS_OF", None]), "none": ([], [None])}
    out = []
    for kind, (own, defaults) in runs.items():
        new = I.infer(facts, own, defaults).where((F.col("p") == V.RDF_TYPE) & F.col("s").startswith("urn:part:"))
        out.append(new.agg(F.count("s").alias("n")).select(F.lit(kind).alias("kind"), "n"))
    return out[0].union(out[1]).union(out[2])

"""How the driver's tables read as quads, shared by all registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadloom import vocab as V
from quadloom.model import Term, iri, lit
from quadloom.sources.tables import Branch, TableQuads, Value, template

P = "urn:p:"
G = "urn:g:"
CLASS = "urn:class:"

# The hand-made class and property declarations.
SUBCLASSES = (
    ("PROMO", "ECONOMY"), ("ECONOMY", "CATALOG"), ("SMALL", "SIZED"), ("MEDIUM", "SIZED"),
    ("LARGE", "SIZED"), ("SIZED", "THING"), ("CATALOG", "THING"), ("STANDARD", "THING"),
)
SCHEMA_TRIPLES = tuple((CLASS + a, V.SUB_CLASS_OF, CLASS + b) for a, b in SUBCLASSES) + (
    (P + "placedBy", V.SUB_PROPERTY_OF, P + "relatedTo"),
    (P + "hasPart", V.SUB_PROPERTY_OF, P + "relatedTo"),
    (P + "inNation", V.EQUIVALENT_PROPERTY, P + "locatedIn"),
    (P + "placedBy", V.INVERSE_OF, P + "placed"),
    (P + "placedBy", V.DOMAIN, CLASS + "Order"),
    (P + "placedBy", V.RANGE, CLASS + "Customer"),
)


# The schemas of the tables; reading with them needs no look at the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ),
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def quads(spark: SparkSession, sf_dir: str) -> TableQuads:
    """All mapped tables as one set of quads."""
    region, nation, customer, supplier, part, orders, lineitem, conversations, documents = (
        table(spark, sf_dir, n)
        for n in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
            "conversations", "documents",
        )
    )
    default = V.DEFAULT_GRAPH
    s_region = template("urn:region:", "r_regionkey")
    s_nation = template("urn:nation:", "n_nationkey")
    s_customer = template("urn:customer:", "c_custkey")
    s_supplier = template("urn:supplier:", "s_suppkey")
    s_part = template("urn:part:", "p_partkey")
    s_order = template("urn:order:", "o_orderkey")
    s_turn = template("urn:turn:", "conv_id", "turn")
    s_doc = template("urn:doc:", "doc_id")
    rich = "c_acctbal > 5000"

    out: list[Branch] = []

    def add(df, graph, subject, name, obj: Value | Term | object, **more):
        predicate = name if ":" in name else P + name
        out.append(Branch(df, graph, subject, predicate, obj, **more))

    add(region, default, s_region, "name", Value("r_name"))
    add(nation, default, s_nation, "name", Value("n_name"))
    add(nation, default, s_nation, "inRegion", template("urn:region:", "n_regionkey"))
    add(nation, default, s_nation, "next", template("urn:nation:", "(n_nationkey + 1) % 25"))
    for graph, where in ((G + "customer", None), (G + "vip", rich)):
        add(customer, graph, s_customer, "name", Value("c_name"), where=where)
        add(customer, graph, s_customer, "inNation", template("urn:nation:", "c_nationkey"), where=where)
        add(customer, graph, s_customer, "acctbal", Value("c_acctbal", V.XSD_DOUBLE), where=where)
        add(customer, graph, s_customer, "segment", Value("c_mktsegment"), where=where)
        add(customer, graph, s_customer, "vip", lit("true"), where=rich)
    add(supplier, G + "supplier", s_supplier, "name", Value("s_name"))
    add(supplier, G + "supplier", s_supplier, "inNation", template("urn:nation:", "s_nationkey"))
    add(supplier, G + "supplier", s_supplier, "acctbal", Value("s_acctbal", V.XSD_DOUBLE))
    add(part, G + "part", s_part, "name", Value("p_name"))
    add(part, G + "part", s_part, "brand", Value("p_brand"))
    add(part, G + "part", s_part, "size", Value("p_size", V.XSD_INTEGER))
    add(part, G + "part", s_part, "price", Value("p_retailprice", V.XSD_DOUBLE))
    add(part, G + "part", s_part, V.RDF_TYPE, template(CLASS, "p_type", integer=False))
    add(orders, G + "orders", s_order, "placedBy", template("urn:customer:", "o_custkey"))
    add(orders, G + "orders", s_order, "status", Value("o_orderstatus"))
    add(orders, G + "orders", s_order, "priority", Value("o_orderpriority"))
    add(orders, G + "orders", s_order, "total", Value("o_totalprice", V.XSD_DOUBLE))
    add(orders, G + "orders", s_order, "date", Value("o_orderdate", V.XSD_DATETIME))
    # order and part do not identify a line, so the edge is made distinct
    edges = lineitem.select("l_orderkey", "l_partkey").distinct()
    add(edges, G + "lineitem", template("urn:order:", "l_orderkey"), "hasPart", template("urn:part:", "l_partkey"))
    turns = conversations.select("conv_id", "turn", "role")
    # turns are numbered without gaps, so every turn but the first follows another
    add(
        turns, G + "conv", template("urn:turn:", "conv_id", "turn - 1"), "next", s_turn,
        where="turn > 0",
    )
    add(turns, G + "conv", s_turn, "role", Value("role"))
    for name, value in (
        ("lang", Value("lang")), ("source", Value("source")), ("chars", Value("n_chars", V.XSD_INTEGER)),
    ):
        add(documents, G + "documents", s_doc, name, value, doc_id="doc_id")
    return TableQuads(tuple(out))


def schema_rows() -> list[tuple]:
    return [(s, p, iri(o)) for s, p, o in SCHEMA_TRIPLES]

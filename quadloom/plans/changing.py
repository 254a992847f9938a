"""Registered queries: updates, graph management, stored quads."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.functions.quad_columns import statements, with_values
from quadloom.model import QUAD_COLUMNS, with_base
from quadloom.operators.patterns import bgp, num, pattern
from quadloom.operators.scan import count_per_graph
from quadloom.operators.updates import Store, in_contexts
from quadloom.plans.mapping import G, P, quads
from quadloom.plans.registry import plain, quads_sql, query
from quadloom.session import materialize, scratch_path
from quadloom.sources.snapshots import SnapshotStore

_COUNTS = "select g, count(*) as n from q group by g"


def _store(spark, sf_dir, *graphs) -> Store:
    """The named graphs, stored, as an updatable state."""
    return _snapshot(spark, sf_dir, *graphs).store()


@query(quads_sql("customer", "vip") + _COUNTS)
def add_set_semantics(spark, sf_dir):
    """Adding statements a graph already holds changes nothing."""
    store = _store(spark, sf_dir, G + "customer", G + "vip")
    again = store.quads.where(F.col("g") == G + "vip")
    return count_per_graph(store.add(again).add(again.union(again)).quads)


@query(
    quads_sql("supplier")
    + """select 'urn:g:copy1' as g, s, p, o_text, o_kind, o_num, o_time from q
union all select 'urn:x-default-graph', s, p, o_text, o_kind, o_num, o_time from q"""
)
def add_fanout_graphs(spark, sf_dir):
    """Explicit contexts override the statements' own graph; several make copies."""
    source = _store(spark, sf_dir, G + "supplier").quads
    empty = Store(source.limit(0))
    return plain(empty.add(source, ["urn:g:copy1", None, "urn:g:copy1"]).quads)


@query(quads_sql() + "select g, count(*) as n from q where p <> 'urn:p:name' group by g")
def remove_pattern_all_graphs(spark, sf_dir):
    return count_per_graph(_store(spark, sf_dir).remove(p=P + "name").quads)


@query(quads_sql("customer", "vip") + "select g, s, p, o_text, o_kind, o_num, o_time from q where g <> 'urn:g:vip' or s <> 'urn:customer:10' and p <> 'urn:p:name'")
def remove_in_graph(spark, sf_dir):
    store = _store(spark, sf_dir, G + "customer", G + "vip")
    return plain(store.remove(s="urn:customer:10", contexts=[G + "vip"]).remove(p=P + "name", contexts=[G + "vip"]).quads)


@query(quads_sql("customer", "vip") + "select g, count(*) as n from q where not (p = 'urn:p:segment' and s in (select s from q where g = 'urn:g:vip')) group by g")
def remove_statements_any_graph(spark, sf_dir):
    """Given statements are removed from every graph that holds them."""
    store = _store(spark, sf_dir, G + "customer", G + "vip")
    gone = store.quads.where((F.col("g") == G + "vip") & (F.col("p") == P + "segment"))
    return count_per_graph(store.remove_statements(gone, any_graph=True).quads)


@query(quads_sql("default", "part") + """
select p, count(*) as n from q where not (s = 'urn:nation:3' and p = 'urn:p:name') and s <> 'urn:none' group by p
""")
def delete_data_typed(spark, sf_dir):
    """DELETE DATA needs the exact term; without a graph it means the default graph."""
    store = _store(spark, sf_dir, V.DEFAULT_GRAPH, G + "part").delete_data(
        [
            ("urn:nation:3", P + "name", lit("NATION_3")),
            ("urn:nation:4", P + "name", lit("NATION_4", lang="en")),  # another term
            ("urn:nation:5", P + "inRegion", lit("urn:region:0")),  # a literal, not the IRI
            ("urn:part:1", P + "brand", lit("Brand#17")),  # not in the default graph
        ]
    )
    return store.quads.groupBy("p").agg(F.count("s").alias("n"))


@query("""
select 'urn:customer:' || c_custkey as s, 'urn:p:segment' as p,
case when c_acctbal > 5000 then 'PRIVATE' else c_mktsegment end as o from customer
""")
def delete_insert_where(spark, sf_dir):
    """Rich customers move to another segment: delete and insert from the old state; only the change is written."""
    store = _snapshot(spark, sf_dir, G + "customer")
    rich = bgp(
        store.read(),
        [("?c", P + "acctbal", "?b"), ("?c", P + "segment", "?old")],
        graph=G + "customer",
    ).filter(num("b") > 5000)
    store.modify(
        rich,
        delete=[("?c", P + "segment", "?old")],
        insert=[("?c", P + "segment", lit("PRIVATE"))],
        graph=G + "customer",
    )
    return store.read(predicates=[P + "segment"]).select("s", "p", "o")


@query("""
select 'urn:nation:' || c_nationkey as s, 'urn:p:hasVip' as p, 'urn:customer:' || c_custkey as o
from customer where c_acctbal > 5000
""")
def insert_where(spark, sf_dir):
    store = _snapshot(spark, sf_dir, G + "vip")
    vips = pattern(store.read(), "?c", P + "inNation", "?n", graph=G + "vip")
    store.modify(vips, insert=[("?n", P + "hasVip", "?c")], graph="urn:g:derived")
    return store.read().where(F.col("g") == "urn:g:derived").select("s", "p", "o")


@query(quads_sql("customer", "supplier") + _COUNTS)
def clear_graph(spark, sf_dir):
    store = _store(spark, sf_dir, G + "customer", G + "vip", G + "supplier")
    return count_per_graph(store.clear([G + "vip"]).quads)


@query("select 0::bigint as n")
def clear_everything(spark, sf_dir):
    return _store(spark, sf_dir).clear().quads.agg(F.count("s").alias("n"))


@query(quads_sql("supplier", "vip") + """
select g, count(*) as n from q group by g
union all select 'urn:g:customer', count(*) from q where g = 'urn:g:supplier'
""")
def copy_graph(spark, sf_dir):
    """The target's old content is gone."""
    store = _snapshot(spark, sf_dir, G + "customer", G + "vip", G + "supplier")
    store.copy_graph(G + "supplier", G + "customer")
    return count_per_graph(store.read())


@query(quads_sql("supplier", "vip") + """
select case when g = 'urn:g:supplier' then 'urn:g:customer' else g end as g, count(*) as n from q group by 1
""")
def move_graph(spark, sf_dir):
    store = _snapshot(spark, sf_dir, G + "customer", G + "vip", G + "supplier")
    store.move_graph(G + "supplier", G + "customer")
    return count_per_graph(store.read())


@query(quads_sql("customer", "vip") + """
select 'urn:g:both' as g, count(*) as n from (select distinct s, p, o_text, o_kind, o_num from q)
union all select 'urn:g:vip', count(*) from q where g = 'urn:g:vip'
""")
def add_graph_create_drop(spark, sf_dir):
    """ADD merges as a set; a created graph is listed, a dropped one is gone."""
    store = _snapshot(spark, sf_dir, G + "customer", G + "vip")
    store.create_graph("urn:g:both")
    store.add_graph(G + "customer", "urn:g:both")
    store.add_graph(G + "vip", "urn:g:both")
    store.drop_graph(G + "customer")
    return count_per_graph(store.read())


# -- stored quads --------------------------------------------------------------------


def _snapshot(spark, sf_dir, *graphs) -> SnapshotStore:
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    q = quads(spark, sf_dir)
    # the tables' keys make every graph a set, so nothing has to be made distinct
    store.write(adds=(q.limited(graphs=list(graphs)) if graphs else q).stacked())
    return store


@query(quads_sql("customer", "vip", "supplier") + "select g, s, p, o_text, o_kind, o_num, o_time from q")
def stored_quads_roundtrip(spark, sf_dir):
    """Quads written and read back."""
    return plain(_snapshot(spark, sf_dir, G + "customer", G + "vip", G + "supplier").read())


@query("""
select 'urn:part:' || p_partkey as part, p_name as name, p_brand as brand, p_size::double as size
from part where p_size > 40
""")
def stored_quads_star(spark, sf_dir):
    """The same patterns over stored quads: only the folders of these predicates are read."""
    q = _snapshot(spark, sf_dir, G + "part").read(predicates=[P + "name", P + "brand", P + "size"])
    sol = bgp(q, [("?part", P + "name", "?name"), ("?part", P + "brand", "?brand"), ("?part", P + "size", "?size")], graph=G + "part")
    return sol.filter(num("size") > 40).select("part", "name", "brand", size=num("size"))


@query(quads_sql("customer", "supplier") + """
select g, s, p, o_text, o_kind, o_num, o_time from q where g = 'urn:g:customer' and p <> 'urn:p:name' and s <> 'urn:customer:10'
union all select g, s, p, o_text, o_kind, o_num, o_time from q where g = 'urn:g:customer' and p = 'urn:p:name' and s = 'urn:customer:11'
union all select 'urn:g:new', s, p, o_text, o_kind, o_num, o_time from q where g = 'urn:g:supplier'
""")
def changeset_commit(spark, sf_dir):
    """Several removals, additions and a clear as one write."""
    store = _snapshot(spark, sf_dir, G + "customer", G + "vip")
    old = store.read().where(F.col("g") == G + "customer")
    extra = quads(spark, sf_dir).limited(graphs=[G + "supplier"]).stacked()
    kept = old.where((F.col("s") == "urn:customer:11") & (F.col("p") == P + "name"))  # removed and added again
    store.write(
        adds=kept.union(in_contexts(extra, ["urn:g:new"])),
        dels=old.where((F.col("p") == P + "name") | (F.col("s") == "urn:customer:10")),
        clear=spark.createDataFrame([(G + "vip",)], "g string"),
    )
    return plain(store.read())


@query(quads_sql("customer", "vip") + "select g, s, p, o_text, o_kind, o_num, o_time from q")
def changeset_rollback(spark, sf_dir):
    """Changes that are never written leave the stored quads as they were."""
    store = _snapshot(spark, sf_dir, G + "customer", G + "vip")
    store.store().remove(p=P + "name").clear([G + "vip"])
    return plain(store.read())


@query(quads_sql("customer", "vip") + """
select 'own' as view, count(*) as n from q where p <> 'urn:p:name'
union all select 'others', count(*) from q
union all select 'committed', count(*) from q where p <> 'urn:p:name'
union all select 'first version', count(*) from q
""")
def changeset_isolation(spark, sf_dir):
    """A planned change is seen by its own reads only, until it is written; a state that was written elsewhere stays."""
    store = _snapshot(spark, sf_dir, G + "customer", G + "vip")
    kept = materialize(store.read(), scratch_path(spark, "kept"))
    own, others = store.store().remove(p=P + "name").quads, store.read()
    store.remove(p=P + "name")
    views = {"own": own, "others": others, "committed": store.read(), "first version": kept}
    out = None
    for name, df in views.items():
        row = df.select(*QUAD_COLUMNS).agg(F.count("s").alias("n")).select(F.lit(name).alias("view"), "n")
        out = row if out is None else out.union(row)
    return out


@query(quads_sql("customer", "vip") + "select g, count(*) as n from q where p <> 'urn:p:vip' group by g")
def snapshot_compact(spark, sf_dir):
    """The live quads written to a new place; the content stays the same."""
    store = _snapshot(spark, sf_dir, G + "customer", G + "vip")
    store.remove(p=P + "vip")
    fresh = SnapshotStore(spark, scratch_path(spark, "store"))
    fresh.write(adds=store.read())
    return count_per_graph(fresh.read())


@query("""
select 'urn:order:' || o_orderkey as s, o_orderpriority as o from orders
""")
def concurrent_adds(spark, sf_dir):
    """Writers that know nothing of each other add slices of the orders at the same time, twice each; all is kept once."""
    path = scratch_path(spark, "store")
    orders = pattern(quads(spark, sf_dir), "?s", P + "priority", "?o", graph=G + "orders")
    rows = orders.df.select("s", "o")
    slices = [rows.where(F.pmod(F.xxhash64("s"), F.lit(4)) == i) for i in range(4)]

    def writer(part):
        new = part.select(
            F.lit("urn:g:many").alias("g"), "s", F.lit(P + "priority").alias("p"), "o", F.lit("lit").alias("o_kind"),
            F.lit(V.XSD_STRING).alias("o_dt"), F.lit(None).cast("string").alias("o_lang"),
            F.lit(None).cast("string").alias("doc_id"),
        )
        return SnapshotStore(spark, path).add(with_values(new))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(writer, slices + slices))
    return SnapshotStore(spark, path).read().select("s", "o")


@query("""
select 'http://example.org/app/done#' || o_orderkey as s, 'http://example.org/p/by' as p, 'urn:customer:' || o_custkey as o
from orders where o_orderstatus = 'F'
union all select 'http://example.org/app/run', 'http://example.com/own', 'http://example.org/x'
""")
def update_relative_iris(spark, sf_dir):
    """Relative IRIs in templates and data are resolved against the base; an IRI with its own base keeps it."""
    base = "http://example.org/app/now"
    store = _snapshot(spark, sf_dir, G + "orders")
    done = bgp(store.read(), [("?o", P + "status", lit("F")), ("?o", P + "placedBy", "?c")], graph=G + "orders")
    named = done.bind("d", F.concat(F.lit("http://example.org/app/done#"), F.substring("o", 11, 20)))
    store.modify(named, insert=[("?d", "../p/by", "?c", "out")], base=base)
    own = with_base("own", "http://example.com/")
    store.add(statements(spark, [("run", own, "/x", "out")], base))
    return store.read().where(F.col("g") == "http://example.org/app/out").select("s", "p", "o")


@query(quads_sql("supplier") + """
select g, s, p, o_text, o_kind, o_num, o_time from q
union all select 'urn:g:supplier', 'urn:supplier:new', 'urn:p:name', 'New', 'lit', null, null
union all select 'urn:x-default-graph', 'urn:supplier:new', 'urn:p:rank', null, 'lit', 7.0, null
""")
def insert_data(spark, sf_dir):
    """INSERT DATA: constant quads, of which some are there already."""
    store = _store(spark, sf_dir, G + "supplier")
    rows = [
        ("urn:supplier:new", P + "name", lit("New"), G + "supplier"),
        ("urn:supplier:new", P + "rank", lit(7)),
        ("urn:supplier:new", P + "name", lit("New"), G + "supplier"),
    ]
    return plain(store.insert_data(rows).insert_data(rows[:1]).quads)

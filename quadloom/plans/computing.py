"""Registered queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadloom import lit
from quadloom import vocab as V
from quadloom.functions import builtins as B
from quadloom.functions import terms as T
from quadloom.operators.patterns import bgp, num, pattern, same_term
from quadloom.operators.solutions import Solutions
from quadloom.plans.mapping import G, P, quads, table
from quadloom.plans.registry import query


def _parts(spark, sf_dir):
    return bgp(quads(spark, sf_dir), [("?part", P + "name", "?name"), ("?part", P + "brand", "?brand")], graph=G + "part")


@query("""
select 'urn:part:' || p_partkey as part, length(p_name) as len, upper(p_name) as up, lower(p_brand) as low,
substring(p_name, 2, 4) as sub, substring(p_name, 3) as tail, contains(p_name, 'ring') as has,
starts_with(p_name, 'red') as starts, ends_with(p_name, 'et') as ends,
case when instr(p_name, ' ') > 0 then substring(p_name, 1, instr(p_name, ' ') - 1) else '' end as before,
case when instr(p_brand, '#') > 0 then substring(p_brand, instr(p_brand, '#') + 1) else '' end as after,
case when instr(p_name, '#') > 0 then 'x' else '' end as nothing,
p_name || '/' || p_brand as both, regexp_replace(p_name, '[aeiou]', '_', 'g') as vowels,
regexp_matches(p_brand, '(?i)BRAND#1.') as matched,
replace(replace(p_brand || ' ' || p_name, '#', '%23'), ' ', '%20') as uri
from part
""")
def string_fns(spark, sf_dir):
    return _parts(spark, sf_dir).select(
        "part",
        len=B.strlen("name").cast("long"),
        up=B.ucase("name"),
        low=B.lcase("brand"),
        sub=B.substr("name", 2, 4),
        tail=B.substr("name", 3),
        has=B.contains("name", "ring"),
        starts=B.strstarts("name", "red"),
        ends=B.strends("name", "et"),
        before=B.strbefore("name", " "),
        after=B.strafter("brand", "#"),
        nothing=B.strbefore("name", "#"),
        both=B.concat("name", F.lit("/"), "brand"),
        vowels=B.replace("name", "[aeiou]", "_"),
        matched=B.regex("brand", "BRAND#1.", "i"),
        uri=B.encode_for_uri(B.concat("brand", F.lit(" "), "name")),
    )


@query("""
select 'urn:order:' || o_orderkey as o, year(o_orderdate) as y, month(o_orderdate) as m, day(o_orderdate) as d,
hour(o_orderdate) as h, minute(o_orderdate) as mi, second(o_orderdate)::double as s, '' as tz from orders
""")
def date_fns(spark, sf_dir):
    sol = pattern(quads(spark, sf_dir), "?o", P + "date", "?t", graph=G + "orders")
    parts = {"y": B.year("t"), "m": B.month("t"), "d": B.day("t"), "h": B.hours("t"), "mi": B.minutes("t")}
    return sol.select(
        "o", **{n: c.cast("long") for n, c in parts.items()}, s=B.seconds("t").cast("double"), tz=B.tz("t")
    )


@query("""
select event_id, year(ts) as y, hour(ts) as h, minute(ts) as mi, '+02:00' as tz,
strftime(ts - interval 2 hour, '%Y-%m-%d %H:%M:%S') as utc from events
""")
def date_fns_with_zone(spark, sf_dir):
    """Parts are those of the written time; comparison uses the instant."""
    events = table(spark, sf_dir, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    df = events.select("event_id", text.alias("t"), F.lit(V.XSD_DATETIME).alias("t__dt"))
    df = df.withColumn("t__ts", T.time_value("t", "t__dt"))
    return df.select(
        "event_id",
        B.year("t").cast("long").alias("y"),
        B.hours("t").cast("long").alias("h"),
        B.minutes("t").cast("long").alias("mi"),
        B.tz("t").alias("tz"),
        F.date_format("t__ts", "yyyy-MM-dd HH:mm:ss").alias("utc"),
    )


@query("""
select 'urn:customer:' || c_custkey as c, abs(c_acctbal) as a, ceil(c_acctbal)::bigint as up, floor(c_acctbal)::bigint as down,
(case when c_acctbal - floor(c_acctbal) >= 0.5 then floor(c_acctbal) + 1 else floor(c_acctbal) end)::double as near,
c_acctbal * 2 + 1 as lin, c_acctbal / nullif(c_nationkey, 0) as per
from customer
""")
def math_fns(spark, sf_dir):
    sol = bgp(quads(spark, sf_dir), [("?c", P + "acctbal", "?b"), ("?c", P + "inNation", "?n")], graph=G + "customer")
    nation = F.expr("try_cast(substring(n, 12) as double)")
    return sol.select(
        "c",
        a=B.abs_(num("b")),
        up=B.ceil(num("b")),
        down=B.floor(num("b")),
        near=B.round_(num("b")),
        lin=num("b") * 2 + 1,
        per=B.divide(num("b"), nation),
    )


@query("""
select 'urn:customer:' || c_custkey as c, c_acctbal > 5000 as vip,
case when c_acctbal > 5000 then 'rich' else 'other' end as label,
coalesce(case when c_acctbal > 5000 then 'true' end, 'none') as flag,
c_mktsegment in ('BUILDING', 'MACHINERY') as listed, c_mktsegment = 'BUILDING' as same,
true as is_lit, false as is_iri_, true as is_num, false as seg_num,
'http://www.w3.org/2001/XMLSchema#double' as dt, '' as lang_
from customer
""")
def logic_fns(spark, sf_dir):
    q = quads(spark, sf_dir)
    base = bgp(q, [("?c", P + "segment", "?seg"), ("?c", P + "acctbal", "?b")], graph=G + "customer")
    sol = base.optional(pattern(q, "?c", P + "vip", "?v", graph=G + "customer"))
    return sol.select(
        "c",
        vip=B.bound("v"),
        label=B.if_(num("b") > 5000, F.lit("rich"), F.lit("other")),
        flag=B.coalesce(F.col("v"), F.lit("none")),
        listed=B.in_("seg", "BUILDING", "MACHINERY"),
        same=same_term("seg", lit("BUILDING")),
        is_lit=B.is_literal("seg"),
        is_iri_=B.is_iri("seg"),
        is_num=B.is_numeric("b"),
        seg_num=B.is_numeric("seg"),
        dt=B.datatype("b"),
        lang_=B.lang("seg"),
    )


@query("""
select doc_id, lang, lang = 'de' or starts_with(lang, 'de-') as german, lang <> '' as any_lang,
upper(lang) || '!' as shout from documents
""")
def lang_fns(spark, sf_dir):
    """Language-tagged literals; string functions keep their argument's tag."""
    docs = table(spark, sf_dir, "documents")
    none = F.lit(None)
    sol = Solutions(
        docs.select(
            "doc_id",
            F.upper("lang").alias("w"),
            F.lit("lit").alias("w__kind"),
            none.cast("string").alias("w__dt"),
            F.lower("lang").alias("w__lang"),
            none.cast("double").alias("w__num"),
            none.cast("timestamp_ntz").alias("w__ts"),
        ),
        ("doc_id", "w"),
        frozenset(["w"]),
    )
    loud = sol.bind("shout", B.concat("w", F.lit("!")), like="w")
    return loud.select(
        "doc_id",
        "shout",
        lang=B.lang("shout"),
        german=B.langmatches(B.lang("w"), "de"),
        any_lang=B.langmatches(B.lang("shout"), "*"),
    )


@query("""
select 'http://example.org/a b/' || url || '/<x>"' as iri, 'x' as o_text from pages where url is not null
""")
def export_odd_iris(spark, sf_dir):
    """IRIs with characters that the grammar excludes are escaped, and read back as they were."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").where("url is not null")
    iri = F.concat(F.lit("http://example.org/a b/"), "url", F.lit('/<x>"'))
    line = F.concat(F.lit("<"), T.escape_iri(iri), F.lit('> <urn:p> "x" .'))
    found = F.regexp_extract(line, "^<([^>]*)> <urn:p> \"(.)\" [.]$", 1)
    return pages.select(T.unescape(found).alias("iri"), F.regexp_extract(line, "\"(.)\" [.]$", 1).alias("o_text"))


@query("""
with forms(n, dt, fine) as (values
  (1, 'integer', true), (2, 'dateTime', true), (3, 'date', true), (4, 'dateTime', false), (5, 'byte', false), (6, 'positiveInteger', true))
select event_id, dt, fine from events, forms
""")
def load_extreme_literals(spark, sf_dir):
    """Integers of forty digits, 24:00:00 and far years are valid; bad hours and bytes out of range aren't."""
    events = table(spark, sf_dir, "events").select("event_id")
    digits = F.lpad(F.col("event_id").cast("string"), 39, "0")
    forms = F.array(*[
        F.struct(o.alias("o"), F.lit(dt).alias("dt"))
        for o, dt in (
            (F.concat(F.lit("9"), digits), "integer"),
            (F.concat(F.lpad((2000 + F.col("event_id") % 1000).cast("string"), 4, "0"), F.lit("-01-01T24:00:00")), "dateTime"),
            (F.concat((400000 + F.col("event_id")).cast("string"), F.lit("-02-28Z")), "date"),
            (F.concat(F.lit("2020-01-01T25:00:0"), (F.col("event_id") % 10).cast("string")), "dateTime"),
            (F.concat(F.lit("-129"), F.col("event_id").cast("string")), "byte"),
            (F.concat(F.lit("1"), digits), "positiveInteger"),
        )
    ])
    rows = events.select("event_id", F.inline(forms))
    fine = T.is_valid_literal("o", F.concat(F.lit(V.XSD), "dt"), F.lit(None).cast("string"))
    return rows.select("event_id", "dt", fine.alias("fine"))


@query("select doc_id, md5(text) as m, sha1(text) as s1, sha256(text) as s256 from documents")
def hash_fns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", B.md5("text").alias("m"), B.sha1("text").alias("s1"), B.sha256("text").alias("s256")
    )


@query("""
select 'urn:customer:' || c_custkey as c, true as iri_ok, true as text_ok, true as rand_ok, true as now_ok
from customer
""")
def fresh_ids(spark, sf_dir):
    """UUID, STRUUID, RAND and NOW give new values, so only their form is shown."""
    sol = pattern(quads(spark, sf_dir), "?c", P + "name", "?name", graph=G + "customer")
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return sol.select(
        "c",
        iri_ok=F.regexp_replace(B.uuid(), "^urn:uuid:", "").rlike(form),
        text_ok=B.struuid().rlike(form),
        rand_ok=B.rand().between(0, 1),
        now_ok=B.now().isNotNull(),
    )


@query("""
select event_id, value as num, event_type as text, event_id::varchar as lex from events
""")
def native_values(spark, sf_dir):
    """Lexical forms back to native values; malformed ones give null."""
    events = table(spark, sf_dir, "events")
    lex = events.select(
        F.col("event_id").cast("string").alias("lex"), F.col("value").cast("string").alias("v"), "event_type"
    )
    return lex.select(
        T.native_value("lex", V.XSD + "long").alias("event_id"),
        T.native_value("v", V.XSD_DOUBLE).alias("num"),
        T.native_value("event_type", V.XSD_STRING).alias("text"),
        "lex",
    )

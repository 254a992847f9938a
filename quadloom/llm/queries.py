"""The registered queries of the operators on text, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.llm import bpe, forest, html, lines, neardup, packing, phrases, quality, repeats, sketches, toxicity, urls, whitening
from quadloom.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return forest.nearest(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranged = sketches.in_ranges(table(spark, sf_dir, "documents"))
    following = F.lead("text").over(sketches.in_order())
    # a text without a next one is a guest, which is left out below
    both = ranged.withColumn("edited", sketches.edited(F.col("text"), F.coalesce(following, F.lit(""))))
    drawn = both.select(
        "doc_id", "range", "guest", "place",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketches.sketch(sketches.shingles(F.col("text"))).alias("own"),
        sketches.sketch(sketches.shingles(F.col("edited"))).alias("changed"),
    )
    ready = drawn.withColumn("next", F.lead("own").over(sketches.in_order())).where("not guest")
    return ready.select(
        "doc_id", "n_chars", "edited_sha256",
        sketches.as_text(F.col("own")).alias("fingerprint"),
        sketches.as_text(F.col("changed")).alias("edited_fingerprint"),
        sketches.resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        sketches.resemblance(F.col("own"), F.col("next")).alias("near_next"),
        sketches.distinct(F.col("own")).alias("n_distinct"),
        sketches.containment(F.col("own"), F.col("changed")).alias("contained_in_edited"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.per_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_nearest, op3_packing, op4_main_text, op5_url_rules,
        op6_fingerprints, op7_near_duplicates, op8_bpe, op9_quality, op10_toxicity, op11_whitening, op12_repeats, op13_phrases,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL: dict[str, str] = {
    "op1_line_dedup": f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key from lines),
shared as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
marked as (
  select k.doc_id, k.line, k.pos, s.key is not null and k.doc_id <> s.keeper as dropped
  from keyed k left join shared s on k.key = s.key)
select doc_id, count(*) as n_lines, (count(*) filter (dropped))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from marked group by doc_id
""",
    "op5_url_rules": f"""
with parts as (
  select page_id, coalesce(translate(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') as host,
         coalesce(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
rules(verdict, host, path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fitting as (
  select p.page_id, p.host, p.path, r.host || r.path as rule, r.verdict,
         row_number() over (partition by p.page_id order by length(r.host || r.path) desc nulls last) as n
  from parts p left join rules r
    on (p.host = r.host or p.host like '%.' || r.host) and starts_with(p.path, r.path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fitting where n = 1
""",
    "op12_repeats": """
with given as (select doc_id, hex(encode(coalesce(text, ''))) as hx from documents),
strings as (select doc_id, unnest(range(0, (length(hx) // 2 - 49)::bigint)) as i, hx from given where length(hx) >= 100),
keyed as (select doc_id, i, substr(hx, 2 * i + 1, 100) as s from strings),
least as (select s, min(doc_id) as keeper from keyed group by s having count(*) > 1),
hits as (select k.doc_id, k.i from keyed k join least l on k.s = l.s where l.keeper < k.doc_id),
marked as (
  select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from hits),
numbered as (select doc_id, i, sum(new) over (partition by doc_id order by i) as span from marked),
spans as (select doc_id, span, min(i) as head, max(i) + 50 as tail from numbered group by doc_id, span),
gaps as (
  select doc_id, span, head, tail, coalesce(lag(tail) over (partition by doc_id order by span), 0) as before from spans),
cut as (
  select g.doc_id, sum(tail - head)::bigint as n_removed, count(*) as n_spans,
         string_agg(substr(hx, (2 * before + 1)::bigint, (2 * (head - before))::bigint), '' order by span) as kept, max(tail) as rest
  from gaps g join given d on g.doc_id = d.doc_id group by g.doc_id)
select d.doc_id, (length(hx) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(kept || substr(hx, (2 * rest + 1)::bigint), hx))) as kept_sha256
from given d left join cut c on d.doc_id = c.doc_id
""",
    "op13_phrases": f"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?' || chr(10) || chr(11) || chr(12) || chr(13) || ']')) as piece
  from documents),
words as (select lang, list_filter(string_split_regex(piece, '[ ' || chr(9) || ']+'), lambda x: x <> '') as w from pieces),
grams as (
  select lang, 1 as k, unnest(w) as phrase from words
  union all select lang, 2, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) from words
  union all select lang, 3, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from words),
f as (select lang, k, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
frequent as (select lang, k, phrase, string_split(phrase, ' ') as w, f from f where f >= 10),
longer as (
  select lang, phrase, max(f) as longer from (
    select lang, w[1] || ' ' || w[2] as phrase, f from frequent where k = 3
    union all select lang, w[2] || ' ' || w[3], f from frequent where k = 3) group by all),
kept as (
  select c.* from frequent c left join longer x on c.lang = x.lang and c.phrase = x.phrase and c.k = 2
  where c.k > 1 and (x.longer is null or 100 * x.longer < 50 * c.f)),
cuts as (
  select lang, phrase, f as a, 1 as cut, w[1] as head, array_to_string(w[2:], ' ') as tail from kept
  union all select lang, phrase, f, 2, w[1] || ' ' || w[2], w[3] from kept where k = 3),
scored as (
  select c.lang, c.phrase, c.a, c.cut, x.f as l, y.f as r,
         ((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join f x on c.lang = x.lang and c.head = x.phrase join f y on c.lang = y.lang and c.tail = y.phrase),
lowest as (select * from (select *, row_number() over (partition by lang, phrase order by score, cut) as u from scored) where u = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
""",
}

"""Bottom-k sketches of documents: the k smallest distinct hashes of word shingles.

Words are runs of other characters than ASCII white space, with A-Z in lower
case; a shingle is five words in a row, or all words of a shorter text.  A
sketch of a union is made of the sketches of its parts; two sketches estimate
resemblance, containment and the number of distinct shingles, exactly while a
set has at most k shingles.  Null and empty texts, and texts of white space,
have the empty sketch; two empty sketches are alike (1), an empty and another
are not (0).  Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quadloom.llm.common import ascii_lower, cut, partitions, prepare

K, WORDS = 256, 5


def shingles(text: Column, n: int = WORDS) -> Column:
    """Distinct 64-bit hashes of the shingles, as an array."""
    trimmed = F.btrim(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")

    def hashed(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) >= n, F.array_distinct(many)).otherwise(F.array(F.xxhash64(w)))

    # a lambda holds the words, so that the text is split once
    inner = F.get(F.transform(F.array(words), hashed), F.lit(0))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(inner)


def sketch(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sets."""
    return sketch(F.array_union(a, b), k)


def merged(sketch_column: str, k: int = K) -> Column:
    """An aggregate: the sketch of the union of all sketches of a group."""
    return sketch(F.array_distinct(F.flatten(F.collect_list(sketch_column))), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the union that two sets have in common."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) / the k-th smallest hash as a share of all."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that is in the second."""
    j = resemblance(a, b, k)
    both = j * distinct(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as hexadecimal text, 16 digits a hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def fingerprints(docs: DataFrame, k: int = K, text_column: str = "text") -> DataFrame:
    """``docs`` with the columns ``sketch`` and ``n_distinct`` (which replace columns of these names)."""
    done = docs.withColumn("sketch", sketch(shingles(F.col(text_column)), k))
    return done.withColumn("n_distinct", distinct(F.col("sketch"), k))


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text, place, ``range`` and ``guest``: documents dealt out by ranges of doc_id (then text; nulls first).

    Each range also holds, as its guest, the first document of the next one; the
    last range holds the first document of all.  A null text is empty.
    """
    spark = prepare(docs.sparkSession)
    kind = "struct<doc_id:bigint,version:bigint>"
    given = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = given.withColumn("place", F.struct("doc_id", F.xxhash64("text").alias("version")).cast(kind))
    dealt = placed.select("place.doc_id", "place.version").repartitionByRange(4 * partitions(spark), "doc_id", "version")
    dealt = cut(dealt.withColumn("range", F.spark_partition_id()), "ranges")
    bounds = dealt.groupBy("range").agg(F.min(F.struct("doc_id", "version")).alias("first"))
    starts = list(dict.fromkeys((r[0]["doc_id"], r[0]["version"]) for r in bounds.select("first").orderBy("first").collect()))  # one row per partition
    if not starts:
        return placed.withColumn("range", F.lit(0)).withColumn("guest", F.lit(False))
    firsts = F.array([F.struct(F.lit(d).cast("bigint"), F.lit(v).cast("bigint")).cast(kind) for d, v in starts])
    # the number of starts up to a place, in two steps
    step = math.isqrt(len(starts)) + 1
    steps = F.array([F.struct(F.lit(d).cast("bigint"), F.lit(v).cast("bigint")).cast(kind) for d, v in starts[::step]])
    coarse = placed.withColumn("coarse", (F.size(F.filter(steps, lambda s: s <= F.col("place"))) - 1) * step)
    fine = F.size(F.filter(F.slice(firsts, F.col("coarse") + 1, step), lambda s: s <= F.col("place")))
    ranged = coarse.withColumn("range", F.col("coarse") + fine)
    before = F.when(F.col("range") == 1, F.lit(len(starts))).otherwise(F.col("range") - 1)
    host = F.array(F.struct("range", F.lit(False).alias("guest")))
    both = F.array(F.struct("range", F.lit(False).alias("guest")), F.struct(before.alias("range"), F.lit(True).alias("guest")))
    heads = F.element_at(firsts, F.col("range")) == F.col("place")
    spread = ranged.withColumn("at", F.when(heads, both).otherwise(host)).drop("coarse", "range")
    return spread.select("doc_id", "text", "place", F.inline("at"))


def in_order() -> WindowSpec:
    """For ``lead`` over what ``in_ranges`` returns; the guests come last and are then left out."""
    return Window.partitionBy("range").orderBy("guest", "place")


def edited(text: Column, following: Column) -> Column:
    """The text whose last quarter is replaced by the beginning of another."""
    gone = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - gone), F.substring(following, F.lit(1), gone))

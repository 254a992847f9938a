"""Removing lines that several documents share.

A line's key is the line without ASCII white space at both ends and with A-Z in
lower case.  Keys of at least ``min_chars`` code points that are found in at
least ``min_docs`` documents are dropped everywhere but in the largest doc_id.

Only 128-bit hashes of keys move: they are dealt out by ranges with document
and position as further sort keys, so a key that a third of all lines share
spans many partitions, and each partition streams its first occurrence per
document and key into partial counts.  The result is one compressed bitmap per
document that loses lines: words of 63 lines that have any dropped line.

A null or empty text is one empty line.  Documents with a null doc_id keep all
lines and count for no key.  Rows with one doc_id count as one document; each
loses its own lines.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.common import ascii_lower, cut, partitions, prepare

MIN_CHARS, MIN_DOCS = 20, 3
WORD = 63  # lines per word of a bitmap
# A key with at least this share of all shared lines is joined apart; so there are at most HOT such keys.
HOT = 500
_SPACE = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(_SPACE)))


def _version(text: Column) -> Column:
    """Tells apart rows that have one doc_id and different texts."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Hashes of the keys that are long enough: h1, h2, doc_id, version, pos."""
    given = docs.where("doc_id is not null").select("doc_id", _version(F.col("text")).alias("version"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    # a line that is too short cannot have a key that is long enough
    keys = given.where(F.length("line") >= min_chars).select("doc_id", "version", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "version", "pos"
    )


def shared_keys(found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2, n_docs and the document that keeps its lines, for the keys of enough documents."""
    ranges = partitions(found.sparkSession)
    dealt = found.select("h1", "h2", "doc_id", "pos").repartitionByRange(ranges, "h1", "h2", "doc_id")
    # equal (key, document) are in one range, so the rows stay where they are and are sorted there
    in_order = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")
    streamed = dealt.withColumn("first", F.lag("pos").over(in_order).isNull())
    # partial counts of each range, added up by key
    counted = streamed.groupBy("h1", "h2").agg(F.count(F.when(F.col("first"), 1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, version, n_dropped and ``dropped``: the non-empty words of the bitmap as (word, bits) in order.

    Documents that keep all lines have no row.
    """
    prepare(docs.sparkSession)
    found = cut(occurrences(docs, min_chars), "lines")
    shared = cut(shared_keys(found, min_docs), "keys")
    total = F.broadcast(shared.agg(F.sum("n_docs").alias("total")))  # one row
    marked = shared.crossJoin(total).withColumn("hot", F.col("n_docs") * HOT >= F.col("total")).drop("total", "n_docs")
    hot = F.broadcast(marked.where("hot").drop("hot"))  # at most HOT rows
    common = found.join(hot, ["h1", "h2"])
    # rows of hot keys are not in the join that deals rows out by key
    rest = found.join(hot, ["h1", "h2"], "left_anti").join(marked.where("not hot").drop("hot"), ["h1", "h2"])
    losing = common.unionByName(rest).where("doc_id <> keeper").select("doc_id", "version", "pos")
    word, bit = F.floor(F.col("pos") / WORD), F.expr(f"shiftleft(1L, int(pos % {WORD}))")
    # equal rows mark the same bits
    words = losing.groupBy("doc_id", "version", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    packed = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return words.groupBy("doc_id", "version").agg(F.sum(F.bit_count("bits")).alias("n_dropped"), packed.alias("dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs`` with the kept lines as ``text``, and n_lines and n_dropped (which replace columns of these names)."""
    maps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), F.col("n_dropped").alias("_n"), F.col("dropped").alias("_dropped")
    )
    joined = docs.join(maps, (F.col("doc_id") == F.col("_doc")) & (_version(F.col("text")) == F.col("_version")), "left")
    # all words up to the last one that has a dropped line, empty ones included
    dense = F.flatten(
        F.transform(
            "_dropped",
            lambda x, i: F.concat(
                F.array_repeat(F.lit(0).cast("long"), (x["word"] - F.when(i == 0, F.lit(0)).otherwise(F.get("_dropped", i - 1)["word"] + 1)).cast("int")),
                F.array(x["bits"]),
            ),
        )
    )
    ready = joined.withColumn("_lines", F.when(F.col("_n").isNotNull(), lines_of(F.col("text")))).withColumn("_bits", dense)
    kept = F.expr(f"array_join(filter(_lines, (x, i) -> coalesce(get(_bits, int(i div {WORD})), 0L) & shiftleft(1L, int(i % {WORD})) = 0L), '\\n')")
    given = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n_lines = (F.length(given) - F.length(F.replace(given, F.lit("\n"), F.lit(""))) + 1).cast("long")
    return ready.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_dropped")],
        F.when(F.col("_n").isNull(), given).otherwise(kept).alias("text"),
        n_lines.alias("n_lines"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_dropped"),
    )

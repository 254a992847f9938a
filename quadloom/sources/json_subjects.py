"""The subjects of RDF/JSON files, however large one file is.

A file is one object with a member per subject.  It is read in pieces that end with a
closing brace, so byte ranges of one file are read by many tasks.  Where a piece stands
(inside a string or not, and how deep) follows from all pieces before it: each byte range
is summed up for both ways it may begin, the few sums are put one after the other, and a
subject ends where a closing brace leads back to the file's own object.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadloom.session import materialize, scratch_path

# Which byte range of which file a piece is in, and its order there.
RANGE = ("file", "block")


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, block, at, text (without its closing brace), and what a piece changes.

    ``quotes``: does it lead into or out of a string?  ``out``: braces opened less those
    closed, and whether its own end closes one, when it begins outside (0) or inside (1).
    """
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    # no escape spans two pieces: a brace is never escaped
    segments = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')
    rows = raw.withColumn("segments", segments).withColumn("quotes", (F.size("segments") + 1) % 2)

    def opened(inside: int) -> str:
        outside = f"array_join(filter(segments, (s, i) -> i % 2 = {inside}), '')"
        return f"length({outside}) - length(replace({outside}, '{{', ''))"

    for inside in (0, 1):
        closes = (F.col("quotes") == inside).cast("int")  # outside at its end
        rows = rows.withColumn(f"closes{inside}", closes).withColumn(f"out{inside}", F.expr(opened(inside)) - closes)
    return rows.drop("segments")


def subjects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line, file): an object with one subject per row, in no order.

    Other text before or after a file's object is a row that no parser takes; blanks and closing braces there count for nothing.
    """
    before = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = _pieces(spark, path).withColumn("turned", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    for begins in (0, 1):  # how the byte range begins
        inside = (F.col("turned") + begins) % 2 == 1
        rows = rows.withColumn(f"end{begins}", F.when(inside, F.col("closes1")).otherwise(F.col("closes0")))
        rows = rows.withColumn(f"step{begins}", F.when(inside, F.col("out1")).otherwise(F.col("out0")))
    rows = rows.withColumns({f"depth{b}": F.sum(f"step{b}").over(upto) for b in (0, 1)})
    keep = ["file", "block", "at", "text", "quotes", *[f"{c}{b}" for b in (0, 1) for c in ("end", "step", "depth")]]
    held = materialize(rows.select(*keep), scratch_path(spark, "json-pieces"))

    # one row per byte range: how it begins
    ranges = held.groupBy(*RANGE).agg(F.sum("quotes").alias("quotes"), *[F.sum(f"step{b}").alias(f"step{b}") for b in (0, 1)])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("begins", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    step = F.when(F.col("begins") == 1, F.col("step1")).otherwise(F.col("step0"))
    ranges = ranges.withColumn("step", step).withColumn("depth", F.coalesce(F.sum("step").over(earlier), F.lit(0)))
    known = held.join(ranges.select(*RANGE, "begins", "depth"), [*RANGE])
    inside = F.col("begins") == 1
    depth = F.col("depth") + F.when(inside, F.col("depth1")).otherwise(F.col("depth0"))
    closed = F.when(inside, F.col("end1")).otherwise(F.col("end0")) == 1
    known = known.select(*RANGE, "at", "text", (closed & (depth == 1)).cast("long").alias("last"))

    ends = known.groupBy(*RANGE).agg(F.sum("last").alias("ends"))
    ends = ends.select(*RANGE, F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("ended"))
    numbered = known.join(ends, [*RANGE]).withColumn("record", F.col("ended") + F.coalesce(F.sum("last").over(before), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct("block", "at", F.concat("text", F.lit("}")).alias("text"))))
    records = numbered.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("body"))
    body = F.regexp_replace("body", r"^\s*[{,]?\s*", "")
    lines = records.select("file", "record", "body", body.alias("own"))
    # the end of the file's object, and the braces that the last piece of a file didn't have
    lines = lines.where(~F.col("own").rlike(r"^[\s}]*$"))
    return lines.select(F.concat(F.lit("{"), "own", F.lit("}")).alias("line"), "file")

"""From raw documents to packed training sequences, one written table per stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
has kept; all but the last one return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.llm import lines, neardup, packing, quality, toxicity
from quadloom.llm.common import cut, prepare, table
from quadloom.llm.queries import VOCABULARY


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic."""
    prepare(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that it shares with at least two others, unless it is the last of them."""
    prepare(spark)
    done = lines.dedup_lines(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return neardup.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    prepare(spark)
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("quality", good_documents),
    ("toxicity", clean_documents),
    ("line_dedup", without_shared_lines),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

# The classifiers and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

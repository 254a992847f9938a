"""Which documents give a quad.

One quad may be given by several documents.  A set of quads keeps one row per quad, so
what the documents are lies beside it, as a relation of quad keys and doc_ids.  Its rows
are made distinct with partial aggregates, so a quad that very many documents give is one
row per document and never one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.model import QUAD_KEY, same

MEMBER = QUAD_KEY + ("doc_id",)


def members_of(rows: DataFrame) -> DataFrame:
    """(quad key, doc_id): every document of every quad, each pair once; quads without a document have no row."""
    return rows.where(F.col("doc_id").isNotNull()).select(*MEMBER).distinct()


def given_by(q: DataFrame, members: DataFrame, documents: DataFrame) -> DataFrame:
    """The quads of ``q`` that one of these documents (column ``doc_id``) gives at least.

    The keys are made distinct before the last join: a quad of many documents weighs one row per task.
    """
    ids = documents.select(F.col("doc_id").cast("string").alias("match_id"))
    found = members.join(ids, F.col("doc_id") == F.col("match_id"), "left_semi")
    keys = found.select(*[F.col(c).alias(c) for c in QUAD_KEY]).distinct()
    return q.join(keys, same(q, keys, QUAD_KEY), "left_semi")


def documents_per_quad(members: DataFrame) -> DataFrame:
    """(quad key, n): how many documents give each quad."""
    return members.groupBy(*QUAD_KEY).agg(F.count("doc_id").alias("n"))

"""Queries constrained by the documents the quads were extracted from.

Each constraint is a condition on a documents table; ``constrain`` keeps the quads
of the documents that satisfy it.  The unit of matching is the whole document.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom.operators.membership import given_by
from quadloom.operators.scan import Quads, frame

MATCH_ALL = "*"


def words(query: str) -> list[str]:
    """The words of a search string, lower case."""
    return [w for w in re.split(r"[\W_]+", query.lower()) if w]


def has_word(text: Column | str, word: str) -> Column:
    """Does the text contain the word, whole and in any case?"""
    text = F.col(text) if isinstance(text, str) else text
    return F.lower(text).rlike(rf"(?<![\p{{L}}\p{{N}}]){re.escape(word.lower())}(?![\p{{L}}\p{{N}}])")


def text_search(query: str, text: Column | str = "text") -> Column:
    """All words of the query occur in the document; ``*`` matches every document."""
    found = [] if query.strip() == MATCH_ALL else [has_word(text, w) for w in words(query)]
    return reduce(lambda a, b: a & b, found, F.lit(True))


def term_query(word: str, text: Column | str = "text") -> Column:
    """A structured query for one word."""
    return has_word(text, word)


def bucket(column: str, bounds: dict[str, tuple[float | None, float | None]]) -> Column:
    """Name of the bucket a value falls in; bounds are (from, below), None = open."""
    out = None
    for name, (low, high) in bounds.items():
        cond = F.lit(True)
        if low is not None:
            cond = cond & (F.col(column) >= low)
        if high is not None:
            cond = cond & (F.col(column) < high)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def in_bucket(column: str, bounds: dict, name: str) -> Column:
    """The value lies in the named bucket (as a range, so it reaches the scan)."""
    low, high = bounds[name]
    cond = F.lit(True)
    if low is not None:
        cond = cond & (F.col(column) >= low)
    if high is not None:
        cond = cond & (F.col(column) < high)
    return cond


def in_directory(directory: str, uri: str = "uri") -> Column:
    """The document's URI lies under a directory."""
    return F.col(uri).startswith(directory if directory.endswith("/") else directory + "/")


def in_collections(names: Iterable[str], collections: str = "collections") -> Column:
    """The document is in one of the collections."""
    return F.arrays_overlap(F.col(collections), F.array(*[F.lit(n) for n in names]))


def constrain(
    q: Quads, documents: DataFrame, condition: Column | None, members: DataFrame | None = None
) -> DataFrame:
    """Quads of the documents that satisfy the condition; None means no constraint.

    ``members`` says which documents give a quad (``membership.members_of``); without it
    every row belongs to its own ``doc_id`` only, which is right for rows as the documents
    gave them, before they were merged into a set.
    """
    df = frame(q)
    if condition is None:
        return df
    return constrain_to(df, documents.where(condition), members)


def constrain_to(q: Quads, documents: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Quads of these documents (column ``doc_id``), such as a search in a text index finds."""
    df = frame(q)
    if members is not None:
        return given_by(df, members, documents)
    ids = documents.select(F.col("doc_id").cast("string").alias("match_id"))
    return df.join(ids, F.col("doc_id") == F.col("match_id"), "left_semi")


def constrained(
    q: Quads,
    documents: DataFrame,
    condition: Column | None = None,
    default: Column | None = None,
    clear: bool = False,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    members: DataFrame | None = None,
) -> DataFrame:
    """The per-query constraint, else the default one, unless it is cleared; then a transform."""
    df = constrain(q, documents, None if clear else condition if condition is not None else default, members)
    return df if transform is None else df.transform(transform)

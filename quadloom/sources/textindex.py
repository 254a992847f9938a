"""A text index: an inverted table of words, kept beside the documents.

    <path>/postings/wh=H/    (word, doc_id), each once, sorted; H: two hex digits of the md5 of the word
    <path>/words/wh=H/       (word, n): how many documents of one build hold the word

A search opens the folders of its words only, reads their stored frequencies (one row
per word), and intersects their postings starting with the rarest word.  The list found
so far is broadcast while its stored size allows it, and joined otherwise.  Texts are
read when the index is built and never by a search.

A word is a run of letters and digits in lower case.  Documents whose text is null have
no words.  Repeated rows of one document count once within a build; ``extend`` takes
documents that the index doesn't hold yet.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.operators.constraints import words
from quadloom.session import materialize, scratch_path

# A list of at most this many documents is sent to all tasks.
BROADCAST_DOCS = 500_000
_POSTINGS = "word string, doc_id string, wh string"
_WORDS = "word string, n long, wh string"


def folder_of(word: str) -> str:
    return hashlib.md5(word.encode()).hexdigest()[:2]


def words_of(text: Column | str) -> Column:
    """The distinct words of a text."""
    found = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_remove(F.array_distinct(found), "")


def postings_of(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, doc_id) of some documents, each once.

    A row gives each of its words once, so only documents of several rows have pairs to merge;
    their keys are found first, without the texts.
    """
    docs = documents.select(F.col(text).alias("text"), F.col(key).cast("string").alias("doc_id")).where("doc_id is not null")

    def pairs(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(words_of("text")).alias("word"), "doc_id")

    several = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("several_id"))
    several = materialize(several, scratch_path(docs.sparkSession, "several"))
    n = several.count()
    if n > BROADCAST_DOCS:
        return pairs(docs).distinct()
    if not n:
        return pairs(docs)
    several, same = F.broadcast(several), F.col("doc_id") == F.col("several_id")
    return pairs(docs.join(several, same, "left_anti")).union(pairs(docs.join(several, same, "left_semi")).distinct())


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    path: str

    # -- writing -----------------------------------------------------------------

    def build(self, documents: DataFrame, text: str = "text", key: str = "doc_id") -> TextIndex:
        """Write the index of these documents in place of what is there."""
        return self._write(postings_of(documents, text, key), "overwrite")

    def extend(self, documents: DataFrame, text: str = "text", key: str = "doc_id") -> TextIndex:
        """Add documents that the index doesn't hold yet."""
        return self._write(postings_of(documents, text, key), "append")

    def _write(self, pairs: DataFrame, mode: str) -> TextIndex:
        build = uuid.uuid4().hex

        def write(rows: DataFrame, name: str, *order: str) -> None:
            # a frequent word is split over tasks, and a folder has few files
            placed = rows.withColumn("build", F.lit(build)).hint("rebalance", "wh").sortWithinPartitions("wh", *order)
            placed.write.mode(mode).partitionBy("build", "wh").parquet(f"{self.path}/{name}")

        write(pairs.withColumn("wh", F.substring(F.md5("word"), 1, 2)), "postings", "word", "doc_id")
        new = self._table("postings", _POSTINGS).where(F.col("build") == build)
        write(new.groupBy("wh", "word").agg(F.count("doc_id").alias("n")), "words", "word")
        return self

    # -- reading -----------------------------------------------------------------

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{schema}, build string").parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], f"{schema}, build string")
            raise

    def _of(self, name: str, schema: str, chosen: Iterable[str]) -> DataFrame:
        """Rows of some words; the hash of a word is a condition on folders."""
        chosen = list(chosen)
        folders = sorted({folder_of(w) for w in chosen})
        return self._table(name, schema).where(F.col("wh").isin(folders) & F.col("word").isin(chosen))

    def frequencies(self, chosen: Iterable[str]) -> dict[str, int]:
        """In how many documents each of these words is; 0 for unknown ones."""
        chosen = sorted(set(chosen))
        rows = self._of("words", _WORDS, chosen).groupBy("word").agg(F.sum("n").alias("n")).collect() if chosen else []
        found = {r["word"]: r["n"] for r in rows}
        return {w: found.get(w, 0) for w in chosen}

    def word_counts(self) -> DataFrame:
        """(word, n): all words and how many documents hold them."""
        return self._table("words", _WORDS).groupBy("word").agg(F.sum("n").alias("n"))

    def postings(self, word: str) -> DataFrame:
        """The documents (doc_id) that hold a word."""
        return self._of("postings", _POSTINGS, [word]).select("doc_id")

    def with_all(self, query: str | Iterable[str]) -> DataFrame:
        """The documents (doc_id) that hold all words, the rarest word first."""
        counts = self.frequencies(_listed(query))
        if not counts:
            raise ValueError("no words to search for")
        rarest, *others = sorted(counts, key=lambda w: (counts[w], w))
        found, most = self.postings(rarest), counts[rarest]
        if not most:
            return found.where(F.lit(False))
        for word in others:
            known = found.select(F.col("doc_id").alias("known_id"))
            # never longer than the rarest word's list, whose size is stored
            known = F.broadcast(known) if most <= BROADCAST_DOCS else known
            found = self.postings(word).join(known, F.col("doc_id") == F.col("known_id")).select("doc_id")
        return found

    def with_any(self, query: str | Iterable[str]) -> DataFrame:
        """The documents (doc_id) that hold one of the words at least, each once."""
        chosen = _listed(query)
        found = self._of("postings", _POSTINGS, chosen).select("doc_id")
        return found.distinct() if len(chosen) > 1 else found

    def search(self, all_of: str | Iterable[str] = (), any_of: str | Iterable[str] = (), none_of: str | Iterable[str] = ()) -> DataFrame:
        """The documents (doc_id) with all, one at least, and none of some words; the first two must not both be empty."""
        if not _listed(all_of) and not _listed(any_of):
            raise ValueError("a search needs words that documents hold")
        found = self.with_all(all_of) if _listed(all_of) else self.with_any(any_of)
        if _listed(all_of) and _listed(any_of):
            found = found.join(self.with_any(any_of), "doc_id", "left_semi")
        if _listed(none_of):
            found = found.join(self.with_any(none_of), "doc_id", "left_anti")
        return found


def _listed(query: str | Iterable[str]) -> list[str]:
    """The distinct words of a search string, or of several."""
    parts = [query] if isinstance(query, str) else list(query)
    return sorted({w for part in parts for w in words(part)})

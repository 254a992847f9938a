"""Phrases whose words occur together more often than apart.

A text is put in lower case (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
these into words ``[^\\x20\\x09]+``.  Prefix polynomials over the words' hashes
(themselves prefix polynomials over bytes) give every n-gram's Rabin-Karp
fingerprint.  Each block of documents deals out its distinct fingerprints with
their counts; a bin adds them up and answers every block, which is the pointer to
the occurrences, with those of its fingerprints that are frequent.  The blocks then
look these up in their texts and count the phrases themselves, so fingerprints of
several phrases separate, and only frequent phrases are ever materialised.

All counts are per language; a null language is ``und``.  A null text is empty.
Repeated rows count as often as they occur, rows with a null or repeated doc_id as
any other; columns besides ``text`` and ``lang`` are left out, so their names cannot
clash.  Ties are broken by the phrase in UTF-8 byte order.  Without rows there are no
phrases.  Long texts are read in segments; a word is held whole.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm import blocks as B
from quadloom.llm.common import cut, prepare

MAX_WORDS, MIN_COUNT, INSIDE_PERCENT, BEST = 3, 10, 50, 2000
UNKNOWN = "und"
BIN_BYTES = 8 << 20  # of text whose fingerprints one bin takes
SEGMENT = 256 << 10  # bytes hashed at once
FLUSH = 6_000_000  # fingerprints of one block that are dealt out at once
SALTS = 64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# 0: part of a word, 1: between words, 2: between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LETTER = B.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _sums(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values times powers, and the inverse powers."""
    size = 1 << max(12, (n + 1).bit_length())
    power, inverse = _powers(size)
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power[:n], out=out[1:])
    return out, inverse


class Grams:
    """The n-grams of one segment: word positions, and for each n the first words and their fingerprints."""

    def __init__(self, start, end, text, found):
        self.start, self.end, self.text, self.found = start, end, text, found


def n_grams(flat: np.ndarray, begins: np.ndarray, salts: np.ndarray, max_words: int) -> Iterator[tuple[int, Grams]]:
    """(number of new words, n-grams) for each segment of some texts.

    ``flat`` holds the texts in lower case, ``begins`` where each one begins, and
    ``salts`` a number for the language of each.
    """
    empty = np.zeros(0, np.int64)
    carry = (empty, empty, empty, empty, np.zeros(0, np.uint64))  # the last words of the segment before
    s, pieces, n = 0, 0, len(flat)
    while s < n:
        e = min(s + SEGMENT, n)
        while e < n and not (stops := np.flatnonzero(_KIND[flat[e : e + SEGMENT]])).size:
            e = min(e + SEGMENT, n)  # a word goes on beyond the segment
        if e < n:
            e += int(stops[0])
        part = flat[s:e]
        kind = _KIND[part]
        word = kind == 0
        new = np.zeros(len(part) + 1, bool)
        new[begins[np.searchsorted(begins, s) : np.searchsorted(begins, e)] - s] = True
        first = word & np.concatenate([[True], ~word[:-1]]) | word & new[:-1]
        last = word & (np.concatenate([~word[1:], [True]]) | new[1:])
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums, inverse = _sums(_LETTER[part], len(part))
        hashed = B.mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
        piece = pieces + np.cumsum(kind == 2, dtype=np.int64)[start]
        pieces += int(np.count_nonzero(kind == 2))
        doc = np.searchsorted(begins, start + s, side="right") - 1
        old = len(carry[0])
        start, end, piece, doc, hashed = (np.concatenate(x) for x in zip(carry, (start + s, end + s, piece, doc, hashed)))
        carry = tuple(x[max(0, len(start) - max_words + 1) :] for x in (start, end, piece, doc, hashed))
        sums, inverse = _sums(hashed, len(hashed))
        found = {}
        for k in range(1, max_words + 1):
            at = np.arange(max(0, old - k + 1), len(start) - k + 1)  # those that end with a new word
            at = at[(piece[at] == piece[at + k - 1]) & (doc[at] == doc[at + k - 1])]
            raw = (sums[at + k] - sums[at]) * inverse[at] + salts[doc[at]] + np.uint64(k)
            found[k] = (at, B.mixed(raw) >> np.uint64(16))
        yield len(start) - old, Grams(start, end, doc, found)
        s = e


def _read(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    table = B.opened(data)
    flat, begins = B.joined_bytes(table["text"])
    langs = table["lang"].to_pylist()
    names = sorted(set(langs))
    salt = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names}
    return _LOWER[flat], begins, np.array([salt[x] for x in langs], np.uint64), langs


def fingerprints(table: DataFrame, bins: int, max_words: int) -> DataFrame:
    """(bin, block, data): the distinct fingerprints of each block, those that occur once there apart from the others."""

    def dealt(block: int, numbers: list[np.ndarray]) -> pa.RecordBatch:
        return B.counted_batch(block, *np.unique(np.concatenate(numbers), return_counts=True), bins)

    def work(block: int, data: bytes) -> Iterator[pa.RecordBatch]:
        flat, begins, salts, _ = _read(data)
        held, size = [], 0
        for _, grams in n_grams(flat, begins, salts, max_words):
            held += [numbers for _, numbers in grams.found.values()]
            size += sum(len(numbers) for _, numbers in grams.found.values())
            if size >= FLUSH:
                yield dealt(block, held)
                held, size = [], 0
        if size:
            yield dealt(block, held)

    return table.select("block", "data").mapInArrow(B.over_rows(work, "block", "data"), B.DEALT)


def counted(table: DataFrame, answers: DataFrame, max_words: int) -> DataFrame:
    """lang, n_words, phrase, f per block: the texts of the frequent fingerprints; n_words 0 counts all words."""

    def work(data: bytes, lists: list[bytes] | None) -> Iterator[pa.RecordBatch]:
        flat, begins, salts, langs = _read(data)
        known = np.unique(np.concatenate([B.unpack48(x) for x in lists])) if lists else np.zeros(0, np.uint64)
        low, names = flat.tobytes(), sorted(set(langs))
        of_doc = np.searchsorted(names, langs)
        single = flat == 32
        words = np.zeros(len(names), np.int64)
        totals: dict[tuple[int, int], Counter] = {}
        for new, grams in n_grams(flat, begins, salts, max_words):
            words += np.bincount(of_doc[grams.text[len(grams.text) - new :]], minlength=len(names))
            for k, (at, numbers) in grams.found.items():
                at = at[B.among(numbers, known)]
                plain = np.ones(len(at), bool)  # one blank between the words
                for j in range(k - 1):
                    plain &= (grams.start[at + j + 1] == grams.end[at + j] + 1) & single[np.minimum(grams.end[at + j], len(flat) - 1)]
                lang = of_doc[grams.text[at]]
                for x in np.unique(lang).tolist():
                    total = totals.setdefault((x, k), Counter())
                    for like, mine in ((True, at[(lang == x) & plain]), (False, at[(lang == x) & ~plain])):
                        cuts = [low[i:j] for i, j in zip(grams.start[mine].tolist(), grams.end[mine + k - 1].tolist())]
                        total.update(cuts if like else [b" ".join(c.split()) for c in cuts])
        rows = [(names[x], 0, b"", int(n)) for x, n in enumerate(words)]
        yield _counted_batch(rows)
        for (x, k), total in totals.items():
            yield _counted_batch([(names[x], k, phrase, f) for phrase, f in total.items()])

    both = B.with_answers(table, lists=answers).select("data", "lists")
    rows = both.mapInArrow(B.over_rows(work, "data", "lists"), "lang string, n_words int, phrase binary, f long")
    return rows.groupBy("lang", "n_words", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f"))


def _counted_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"lang": pa.string(), "n_words": pa.int32(), "phrase": pa.binary(), "f": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], list(kinds))


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, n_words, phrase, f of all phrases that occur at least ``min_count`` times; n_words 0: all words of the language."""
    prepare(docs.sparkSession)
    given = docs.select(
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    )
    table = B.blocks(given, "phrase-blocks")
    answers = cut(B.frequent(fingerprints(table, B.bins_for(table, BIN_BYTES), max_words), min_count), "frequent")
    return cut(counted(table, answers, max_words).where((F.col("f") >= min_count) | (F.col("n_words") == 0)), "phrases")


def _words(phrase: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT, best: int = BEST
) -> DataFrame:
    """Each language's ``best`` phrases: lang, rank, phrase, a, l, r, n, score.

    The score floor(1000000 * a * a / (l * r)) of the lowest cut counts; a phrase
    inside a longer one that has at least ``inside_percent`` of its count is left out.
    """
    counts = phrase_counts(docs, max_words, min_count)
    known = counts.where("n_words > 0").select("lang", "phrase", "f")
    phrases = counts.where("n_words > 1")

    # the greatest count of a longer phrase, for every phrase inside it
    inner = F.transform(
        F.filter(
            F.flatten(F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("n_words") - k + 1), lambda i: F.struct(i.alias("i"), k.alias("k"))))),
            lambda x: x["k"] >= 2,
        ),
        lambda x: _words(F.col("phrase"), x["i"], x["k"]),
    )
    longer = phrases.where("n_words > 2").select("lang", F.explode(inner).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("f"), F.lit(True)))

    cuts = kept.select("lang", "phrase", "n_words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _words(F.col("phrase"), F.lit(1), F.col("k")), "right": _words(F.col("phrase"), F.col("k") + 1, F.col("n_words") - F.col("k"))})
    for side, name in (("left", "l"), ("right", "r")):
        part = known.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumn("_up", F.lit(1000000).cast("decimal(7,0)") * (wide["a"] * wide["a"])).withColumn("_low", wide["l"] * wide["r"])
    scored = cuts.withColumn("score", F.expr("_up div _low"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x"))
    lowest = lowest.select("lang", "phrase", "x.*")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    some = lowest.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= best).drop("rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    totals = counts.where("n_words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))

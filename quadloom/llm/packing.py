"""Packing of tokenized documents into sequences of fixed length by patterns of lengths.

Only the histogram of piece lengths (at most ``max_len`` numbers) leaves the
cluster.  All patterns of two or three lengths that fill a sequence exactly are
enumerated, non-negative least squares fits how often each is repeated, the
counts are rounded within what there is, and the lengths left over are packed
best-fit, longest first, still as counts.  Every piece then finds its place by
its rank among the pieces of its length.

A null text is empty and its document is the end id alone.  Repeated rows are
packed as often as they occur.  A null id is kept.  Other columns are left out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.automaton import automaton
from quadloom.llm.common import by_batch, column, cut, prepare

MAX_LEN = 2048
END_ID = 0
# Pieces of one length that are ranked in one group.
RANKED = 100_000
# Steps of the least-squares fit; more leave fewer lengths to the residual packing.
FIT_STEPS = 150
# Shares of the fitted repeats that are tried; what a share leaves over is packed best-fit.
SHARES = (1.0, 0.95, 0.8, 0.5, 0.2)


def pieces(docs: DataFrame, vocabulary: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    prepare(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def work(batch):
        encoded = [x + end for x in automaton(vocabulary).encode_all(column(batch, "text").to_pylist())]
        counts = [-(-len(x) // (4 * max_len)) for x in encoded]
        views = map(memoryview, encoded)
        cut_ = [(k, k * max_len, x[4 * k * max_len : 4 * (k + 1) * max_len]) for x, n in zip(views, counts) for k in range(n)]
        rows = np.repeat(np.arange(len(counts)), counts)
        return {
            "doc_id": column(batch, "doc_id").take(pa.array(rows)),
            "piece": pa.array([x[0] for x in cut_], pa.int32()),
            "start": pa.array([x[1] for x in cut_], pa.int64()),
            "length": pa.array([len(x[2]) // 4 for x in cut_], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x[2]) for x in cut_], pa.int64()),
        }

    given = docs.selectExpr("doc_id", "cast(text as string) as text")
    return given.mapInArrow(by_batch(work), "doc_id long, piece int, start long, length long, ids_crc32 long")


def fit(counts: np.ndarray, steps: int = FIT_STEPS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) and their repeats for ``counts[length]`` pieces of each length.

    Every piece is in exactly one pattern; no pattern exceeds ``len(counts) - 1``.
    Of the shares of the fitted repeats that are tried, the one with the fewest sequences counts.
    """
    full = len(counts) - 1
    left = counts.astype(np.int64).copy()
    alone = [((full,), int(left[full]))] if left[full] else []
    left[full] = 0
    slots, x = _least_squares(left, steps)
    tried = [_rounded(left, slots, share * x) for share in SHARES]
    return alone + min(tried, key=lambda patterns: sum(n for _, n in patterns))


def _rounded(counts: np.ndarray, slots: np.ndarray, x: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeats within what there is, patterns with long pieces first, and the rest packed best-fit."""
    left, out = counts.copy(), []
    # many patterns have less than one repeat: neighbours, which are alike, share a rounded one
    rounded = np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0).astype(np.int64)
    for k in np.flatnonzero(rounded):
        lengths = [int(v) for v in slots[k] if v]
        repeats = min([int(rounded[k])] + [int(left[v]) // lengths.count(v) for v in lengths])
        if repeats > 0:
            out.append((tuple(lengths), repeats))
            for v in lengths:
                left[v] -= repeats
    return out + _best_fit(left)


def _least_squares(counts: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of two or three lengths that fill a sequence, and non-negative repeats nearest to the counts.

    Multiplicative steps keep the repeats non-negative and never enlarge the misfit, which counts more for
    long pieces: short ones left over still fit somewhere.  A pattern's column has at most three entries,
    so nothing dense is built.
    """
    full = len(counts) - 1
    there = np.flatnonzero(counts)
    known = counts > 0
    two = [(full - a, a, 0) for a in there[there <= full // 2] if known[full - a]]
    three = []
    for a in there[there <= full // 3]:
        b = there[(there >= a) & (there <= (full - a) // 2)]
        c = full - a - b
        b, c = b[known[c]], c[known[c]]
        three.append(np.stack([c, b, np.full(len(b), a)], 1))
    slots = np.concatenate([np.array(two, np.int64).reshape(-1, 3), *three]).astype(np.int64)
    if not len(slots):
        return slots, np.zeros(0)
    slots = slots[np.lexsort((-slots[:, 2], -slots[:, 1], -slots[:, 0]))]
    flat, weight = slots.ravel(), np.arange(full + 1) / np.maximum(1.0, counts) / full
    wanted = (weight * counts)[slots].sum(1)
    used = np.maximum(1, np.bincount(flat, minlength=full + 1))
    share = (counts / used)[slots]
    share[slots == 0] = np.inf
    x = share.min(1)
    for _ in range(steps):
        made = np.bincount(flat, weights=np.repeat(x, 3), minlength=full + 1)
        x = x * wanted / np.maximum(1e-12, (weight * made)[slots].sum(1))
    return slots, x


def _best_fit(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over counts: each open sequence with the least room that fits takes the next piece."""
    full = len(left) - 1
    rooms: list[int] = []  # rooms of open sequences, ascending
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in open_:
            insort(rooms, room)
            open_[room] = []
        open_[room].append((pattern, n))

    for length in range(full, 0, -1):
        todo = int(left[length])
        while todo:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                each = full // length
                bins, rest = divmod(todo, each)
                if bins:
                    put(full - each * length, (length,) * each, bins)
                if rest:
                    put(full - rest * length, (length,) * rest, 1)
                break
            room = rooms[k]
            pattern, n = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(k)
            take = min(n, todo)
            if n > take:
                put(room, pattern, n - take)
            put(room - length, (*pattern, length), take)
            todo -= take
    return [x for groups in open_.values() for x in groups]


class Places:
    """Where the piece of some rank among those of its length goes; its size is bounded by the number of patterns."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        slots: list[tuple[int, int, int, int]] = []
        base = 0
        for lengths, repeats in patterns:
            offset = 0
            for v in lengths:
                slots.append((v, repeats, base, offset))
                offset += v
            base += repeats
        slots.sort(key=lambda s: s[0])  # stable: the order of the patterns holds within a length
        a = np.array(slots, np.int64).reshape(-1, 4)
        self.sequences = base
        self.length, self.base, self.offset = a[:, 0], a[:, 2], a[:, 3]
        self.begin = np.cumsum(a[:, 1]) - a[:, 1]  # over all slots in order of length
        first = np.searchsorted(self.length, self.length)
        self.zero = self.begin[first] if len(a) else self.begin

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.zero[np.searchsorted(self.length, length)] + rank
        k = np.searchsorted(self.begin, at, side="right") - 1
        return self.base[k] + at - self.begin[k], self.offset[k]


def pack(docs: DataFrame, vocabulary: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut_ = pieces(docs, vocabulary, max_len, end_id)
    # the row number makes equal rows distinct; written, it stays the same however often it is read
    all_pieces = cut(cut_.withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = np.zeros(max_len + 1, np.int64)
    for r in all_pieces.groupBy("length").count().collect():  # at most max_len rows
        histogram[r["length"]] = r["count"]
    places = spark.sparkContext.broadcast(Places(fit(histogram)))

    # ranks within a length: a count per group of the length, and the rank within the group
    groups = F.array([F.lit(int(1 + n // RANKED)) for n in histogram])
    dealt = all_pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.element_at(groups, (F.col("length") + 1).cast("int"))))
    before = dealt.groupBy("length", "group").count()
    upto = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "group", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "group").orderBy("row")
    ranked = dealt.withColumn("rank", F.row_number().over(within) - 1).join(before, ["length", "group"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def work(batch):
        length, rank = (column(batch, c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        sequence, offset = places.value.find(length, rank)
        keep = {c: column(batch, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
        return keep | {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(by_batch(work), kinds)


def sequences(docs: DataFrame, placed: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """The packed ids: sequence_id, doc_ids and ids in order; documents with distinct ids that aren't null."""
    from quadloom.llm.bpe import encode

    end = np.array([end_id], "<u4").tobytes()
    whole = encode(docs, vocabulary).withColumn("ids", F.concat("ids", F.lit(end)))
    part = F.expr("substring(ids, int(4 * start + 1), int(4 * length))")
    rows = placed.join(whole, "doc_id").select("sequence_id", "offset", "doc_id", part.alias("ids"))
    grouped = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    joined = F.aggregate("p.ids", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    return grouped.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), joined.alias("ids"))

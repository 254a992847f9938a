"""Nearest neighbours by a forest of hash prefixes.

Rows are dealt out at random to blocks of bounded size, and each block has a
forest of its own: in every tree a vector has a long string of bits, one per
random direction (is its projection above the block's median?), and the strings
are a sorted array.  A query descends to its longest matching prefix in every
tree; then all trees ascend together, one bit at a time, until the prefixes
hold a set share of the block.  The distances to all these candidates are
exact.  Queries visit every block, in batches, and the best of all blocks count.

The share is a constant because nearly all distances in high-dimensional data
are alike: a constant number of candidates would lose recall as data grow.

Vectors that are null or zero, or hold a null or a non-finite component, take
no part, and rows with another number of components than a query aren't
its candidates.  Rows that are repeated count once; of rows with one id and
different vectors the nearest counts.  Equal vectors tie, and ties go to the
smaller id.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.common import column, cut, prepare

TREES, BITS = 40, 24
SHARE = 0.5
LEAST = 256  # candidates, of every block that has as many
BLOCK_ROWS = 16_384
SEED = 11


class Forest:
    """The trees of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.ids, self.vectors, self.trees, self.bits = ids, vectors, trees, bits
        rng = np.random.default_rng(SEED)
        self.axes = rng.standard_normal((vectors.shape[1], trees * bits))
        along = vectors @ self.axes
        self.middle = np.median(along, axis=0)
        codes = self._codes(along)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def _codes(self, along: np.ndarray) -> np.ndarray:
        bits = (along > self.middle).reshape(len(along), self.trees, self.bits).astype(np.int64)
        return (bits << np.arange(self.bits - 1, -1, -1)).sum(2).T.copy()

    def candidates(self, queries: np.ndarray, share: float = SHARE) -> Iterator[np.ndarray]:
        """For each query the rows under the prefixes where the ascent ends."""
        share = max(share, min(1.0, LEAST / len(self.ids)))
        codes = self._codes(queries @ self.axes)
        n, m = len(self.ids), len(queries)
        level = np.full(m, self.bits)
        open_ = np.ones(m, bool)
        for up in range(self.bits + 1):  # all trees give up one more bit
            begin, end = self._ranges(codes, up)
            found = 1 - np.prod(1 - (end - begin) / n, axis=0)  # as if trees were independent: never too few bits
            level[open_ & (found >= share)] = up
            open_ &= found < share
            if not open_.any():
                break
        for q in range(m):
            mark = np.zeros(n, bool)
            for up in range(int(level[q]), self.bits + 1):  # and more where they hold the same rows
                begin, end = self._ranges(codes[:, q : q + 1], up)
                for order, i, j in zip(self.order, begin[:, 0], end[:, 0]):
                    mark[order[i:j]] = True
                if np.count_nonzero(mark) >= share * n:
                    break
            yield np.flatnonzero(mark)

    def _ranges(self, codes: np.ndarray, up: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the prefixes without the last ``up`` bits begin and end in each tree."""
        low = codes >> up << up
        begin = np.stack([np.searchsorted(s, x) for s, x in zip(self.sorted, low)])
        return begin, np.stack([np.searchsorted(s, x + (1 << up)) for s, x in zip(self.sorted, low)])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float = SHARE) -> list[tuple[int, int, float]]:
        """(query, row, distance) of up to ``k`` nearest candidates with another id, in order of distance and id."""
        out = []
        for q, rows in enumerate(self.candidates(queries, share)):
            away = self.vectors[rows] - queries[q]
            far = np.sqrt((away * away).sum(1))
            other = self.ids[rows] != query_ids[q]
            rows, far = rows[other], far[other]
            best = np.lexsort((self.ids[rows], far))
            taken: set[int] = set()
            for x in best:
                if len(taken) == k:
                    break
                i = int(self.ids[rows[x]])
                if i not in taken:
                    taken.add(i)
                    out.append((int(query_ids[q]), i, float(far[x])))
        return out


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _searched(k: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of block and size; of each the rows of the block before its queries."""
        block, ids, vectors, forest = None, [], [], None
        for batch in batches:
            keys = np.stack([column(batch, c).to_numpy(zero_copy_only=False) for c in ("block", "width", "asks")], 1)
            given = column(batch, "id").to_numpy(zero_copy_only=False)
            flat = column(batch, "vector")
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)]).tolist() + [len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                own = tuple(keys[a, :2].tolist())
                held = flat.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b - a, -1)
                if own != block:
                    block, ids, vectors, forest = own, [], [], None
                if not keys[a, 2]:
                    ids.append(given[a:b])
                    vectors.append(held)
                elif ids:
                    forest = forest or Forest(np.concatenate(ids), np.concatenate(vectors))
                    found = forest.search(given[a:b], held, k, share)
                    arrays = [pa.array([x[c] for x in found], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "id", "score"])

    return run


def nearest(rows: DataFrame, queries: DataFrame, id_column: str, vector_column: str, k: int = 10, share: float = SHARE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, ``id_column`` and score (Euclidean distance): the nearest rows found with another id than the query."""
    spark = prepare(rows.sparkSession)

    def given(df: DataFrame) -> DataFrame:
        vector = F.col(f"`{vector_column}`").cast("array<double>")
        named = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), vector.alias("vector")).where("id is not null")
        return named.where(usable(F.col("vector"))).dropDuplicates(["id", "vector"]).withColumn("width", F.size("vector"))

    held = cut(given(rows), "vectors")
    blocks = max(1, -(-held.count() // block_rows))
    placed = held.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")).withColumn("asks", F.lit(0))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = cut(given(queries), "queries").withColumn("block", every).withColumn("asks", F.lit(1))
    both = placed.select("block", "width", "asks", "id", "vector").union(asked.select("block", "width", "asks", "id", "vector"))
    dealt = both.repartition(blocks, "block").sortWithinPartitions("block", "width", "asks", "id")
    found = dealt.mapInArrow(_searched(k, share), "query_id long, id long, score double")
    nearest_first = Window.partitionBy("query_id").orderBy("score", "id")
    # the best of all blocks; a row that came with two vectors counts once
    once = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")

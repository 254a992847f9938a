"""Whitening of vectors by the covariance of their distinct values.

Each entry becomes an integer on a grid, equal vectors are grouped and counted, and
the covariance is a weighted product of the centred distinct vectors, each with its
count or with one as its weight.  Sums are exact integers; the products are summed up
in each task and added up by rows of the matrix, so only matrices of the vectors' own
dimension meet at the driver.  Every distinct vector is whitened once and joined back.

Rows without a vector, with an empty one, or with a null or non-finite entry take no
part, nor do those of another length than most (of equally common lengths: the longer
one) and those with an entry beyond 64 bits on the grid.  Repeated rows and rows with
a null id stay, each with its own result.  Components without variance (below 1e-12 of
all, so all of them when there is one distinct vector) have no rows; an empty table
gives none.  Columns besides the id and the vector are left out, so their names cannot
clash.  A deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.llm.common import column, cut, partitions, prepare

GRID = 256
COMPONENTS = 4
NO_VARIANCE = 1e-12
_MOST = 2**62


def on_grid(rows: DataFrame, id_column: str, vector_column: str, grid: int = GRID) -> DataFrame:
    """vec_id and x, the vector's integers, of the rows that take part."""
    given = rows.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    # NaN is not below infinity, and a null makes the whole condition null
    fine = given.where(F.size("v") > 0).where(
        F.aggregate("v", F.lit(True), lambda ok, c: ok & F.coalesce(F.abs(F.floor(grid * c).cast("double")) < F.lit(2.0**63), F.lit(False)) & F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    )
    x = F.transform("v", lambda c: F.floor(F.lit(float(grid)) * c).cast("long"))
    fine = fine.select("vec_id", x.alias("x"))
    sizes = fine.groupBy(F.size("x").alias("size")).count()
    size = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return fine.where(F.size("x") == (size["size"] if size else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = column(batch, "x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _weights(batch: pa.RecordBatch, by_count: bool) -> np.ndarray:
    n = column(batch, "n").to_numpy(zero_copy_only=False)
    return n if by_count else np.ones_like(n)


def totals(distinct: DataFrame, by_count: bool) -> tuple[int, list[int]]:
    """The weight of all distinct vectors, and the exact weighted sum of each dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = _weights(batch, by_count)
                x = _matrix(batch)
                if int(np.abs(x.astype(float)).max() + 1) * int(w.sum()) >= _MOST:  # rare: integers of any length
                    x, w = x.astype(object), w.astype(object)
                sums = [int(s) for s in (x * w[:, None]).sum(0)]
                rows = [int(w.sum()), *sums]
                yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums)), pa.int32()), pa.array([str(s) for s in rows])], ["i", "s"])

    parts = distinct.mapInArrow(run, "i int, s string")
    rows = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # one row per dimension
    found = {r["i"]: int(r["s"]) for r in rows}
    return found.pop(-1, 0), [found[i] for i in sorted(found)]


def covariance(distinct: DataFrame, n: int, sums: list[int], by_count: bool) -> np.ndarray:
    """The weighted covariance, centred before multiplying, divisor ``n``."""
    mean = np.array([s / n for s in sums])
    d = len(sums)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch) - mean
                total += (centred * _weights(batch, by_count)[:, None]).T @ centred
        yield _rows_of(dict(enumerate(total)))

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(column(batch, "i").to_pylist(), column(batch, "row")):
                total[i] = total.get(i, 0) + np.array(row.values)
        if total:
            yield _rows_of(total)

    # a task adds up some rows of the matrix, over all tasks that came before
    rows = distinct.mapInArrow(partial, "i int, row array<double>")
    tasks = min(d, partitions(distinct.sparkSession))
    summed = rows.repartitionById(tasks, F.pmod("i", F.lit(tasks))).mapInArrow(added, "i int, row array<double>")
    out = np.zeros((d, d))
    for r in summed.collect():  # the matrix
        out[r["i"]] = r["row"]
    return out / n


def _rows_of(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([list(r) for r in rows.values()], pa.list_(pa.float64()))], ["i", "row"])


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors, as columns."""
    e, u = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-e, kind="stable")[:most]
    order = order[e[order] > NO_VARIANCE * max(np.trace(v), 0.0)]
    return e[order], u[:, order]


def whiten(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    most: int = COMPONENTS,
    by_count: bool = False,
    grid: int = GRID,
) -> DataFrame:
    """vec_id, x, weight, n, deviation, whitened (array), explained (array) and identity_error of every row that takes part."""
    spark = prepare(rows.sparkSession)
    given = on_grid(rows, id_column, vector_column, grid)
    # each distinct vector once; equal ones are counted before they are shuffled
    distinct = cut(given.groupBy("x").agg(F.count("*").alias("n")), "distinct-vectors")
    n, sums = totals(distinct, by_count)
    v = covariance(distinct, n, sums, by_count) if n else np.zeros((0, 0))
    e, u = components(v, most)
    mean = np.array([s / n for s in sums])
    scaled = u / np.sqrt(e)
    share = (e / np.trace(v)).tolist() if len(e) else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            most_ = int(np.abs(x.astype(float)).max() + 1) * n + max(map(abs, sums))
            if most_ * most_ * x.shape[1] >= _MOST:
                apart = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
                apart = [a if a < 2**63 else None for a in apart]
            else:
                apart = ((n * x - np.array(sums, np.int64)) ** 2).sum(1)
            white = (x - mean) @ scaled
            yield pa.RecordBatch.from_arrays(
                [column(batch, "x"), column(batch, "n"), pa.array(apart, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                ["x", "weight", "deviation", "whitened"],
            )

    whitened = cut(distinct.mapInArrow(run, "x array<long>, weight long, deviation long, whitened array<double>"), "whitened")
    error = _identity_error(whitened, n, len(e), by_count)
    own = whitened.select(F.xxhash64("x").alias("_h"), F.col("x").alias("_x"), "weight", "deviation", "whitened")
    back = given.withColumn("h", F.xxhash64("x")).join(own, (F.col("h") == F.col("_h")) & (F.col("x") == F.col("_x")))
    return back.select(
        "vec_id", "x", "weight", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(s) for s in share]).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(whitened: DataFrame, n: int, k: int, by_count: bool) -> float | None:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    if not k:
        return None
    flat = whitened.select(F.col("weight").alias("n"), F.col("whitened").alias("x"))
    weight = F.col("n") if by_count else F.lit(1)
    means = flat.agg(*[(F.sum(weight * F.col("x")[i]) / n).alias(f"m{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    products = [(F.sum(weight * (F.col("x")[i] - means[i]) * (F.col("x")[j] - means[j])) / n).alias(f"c{i}_{j}") for i, j in pairs]
    row = flat.agg(*products).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def per_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, components numbered from 1."""
    both = F.arrays_zip("whitened", "explained")
    out = whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(both).alias("at", "c"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )

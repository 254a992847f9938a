"""What the operators on text share: tables, intermediate tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.session import materialize, scratch_path, tune

# Bounds of one Arrow batch, so that a task's Python memory does not depend on the lengths of texts.
BATCH_ROWS = 500
BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on; all can be changed at run time."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a lost executor costs no earlier stage."""
    return materialize(df, scratch_path(df.sparkSession, label))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; texts that are all ASCII take the quick way."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, upper, lower))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def by_batch(
    work: Callable[[pa.RecordBatch], dict[str, pa.Array]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` from one that turns a batch into named arrays."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
        pa.default_memory_pool().release_unused()  # workers live on, next to the executor's heap

    return run


def filtered(docs: DataFrame, keeps: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """The rows of ``docs`` with all their columns for which ``keeps`` gives true."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(keeps(batch))
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)


def values(batch: pa.RecordBatch, name: str) -> list:
    """A column's values; nulls where there is no such column."""
    at = batch.schema.get_field_index(name)
    return batch.column(at).to_pylist() if at >= 0 else [None] * batch.num_rows

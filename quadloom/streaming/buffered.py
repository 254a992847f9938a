"""Buffered writes as Structured Streaming queries.

Every micro-batch is made distinct and becomes one folder of a ``SnapshotStore``,
named after the stream and the batch: a batch that is replayed after a failure
replaces its own folder.  A batch reads nothing of what is stored, so its cost
doesn't grow with the store; what batches repeat is merged when it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quadloom.functions.quad_columns import with_values
from quadloom.model import QUAD_KEY
from quadloom.operators.membership import MEMBER
from quadloom.sources.snapshots import SnapshotStore, stream_batch

INSERT, DELETE = "insert", "delete"


@dataclass(frozen=True)
class BufferOptions:
    """When a buffer is flushed.

    ``interval`` is the time between flushes; None drains what is there and stops.
    The files or bytes of a batch are limited where the stream is read
    (``source_options``); a batch of more than ``max_rows`` quads is written in parts.
    """

    interval: str | None = None
    max_files: int | None = None
    max_rows: int | None = None
    max_bytes: str | None = None  # a size such as "1g"

    def source_options(self) -> dict[str, str]:
        limits = {"maxFilesPerTrigger": self.max_files, "maxBytesPerTrigger": self.max_bytes}
        return {name: str(limit) for name, limit in limits.items() if limit is not None}


def _start(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, options: BufferOptions):
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if options.interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=options.interval).start()


def insert_stream(
    stream: DataFrame, store: SnapshotStore, checkpoint: str, options: BufferOptions = BufferOptions()
) -> StreamingQuery:
    """Add a stream of quads to a store (set union)."""

    def batch(df: DataFrame, batch_id: int) -> None:
        with _parts(df, options.max_rows) as (rows, parts):
            store.add(rows, batch=stream_batch(checkpoint, batch_id), parts=parts)

    return _start(stream, batch, checkpoint, options)


def change_stream(
    stream: DataFrame, store: SnapshotStore, checkpoint: str, options: BufferOptions = BufferOptions()
) -> StreamingQuery:
    """Apply a stream of ``op`` ('insert' / 'delete') rows over quads, in ``seq`` order.

    The operation with the highest ``seq`` on a quad counts, whichever batch brings
    it, and an insert before a delete of equal ``seq``.  A quad that stays belongs to all
    documents that inserted it since it was last removed.  Where other writers remove
    quads of the same store, ``seq`` must be on their scale (microseconds since 1970).
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        with _parts(df, options.max_rows) as (part, parts):
            at = F.struct("seq", "op")
            final = part.groupBy(*QUAD_KEY).agg(F.max(at).alias("last"), F.max_by("doc_id", at).alias("doc_id"))
            final = final.select(*QUAD_KEY, "doc_id", "last.seq", "last.op")
            adds = with_values(final.where(F.col("op") == INSERT), "seq")
            dels = part.where(F.col("op") == DELETE).select(*QUAD_KEY, "seq")
            docs = part.where((F.col("op") == INSERT) & F.col("doc_id").isNotNull()).select(*MEMBER, "seq")
            store.write(adds=adds, dels=dels, docs=docs, batch=stream_batch(checkpoint, batch_id), parts=parts)

    return _start(stream, batch, checkpoint, options)


@contextmanager
def _parts(df: DataFrame, max_rows: int | None) -> Iterator[tuple[DataFrame, int | None]]:
    """A batch, and how many parts of about ``max_rows`` rows it has; each is written to a folder of its own.

    Parts are shares of the quads' hash, so a quad is in one part only, and a batch that
    is delivered again has the same parts.  One job writes all of them: a batch is read once,
    however many parts it has.
    """
    if max_rows is None:
        yield df, None
        return
    held = df.persist()
    try:
        yield held, max(1, -(-held.count() // max_rows))
    finally:
        held.unpersist()


class Buffer:
    """A running buffered write that can be flushed on demand.

    ``start`` is called with options and returns the running query, for example
    ``lambda options: insert_stream(stream, store, checkpoint, options)``.
    """

    def __init__(self, start: Callable[[BufferOptions], StreamingQuery], options: BufferOptions):
        self._start, self.options = start, options
        self.query = start(options)

    def flush(self) -> None:
        """Store everything that has arrived; raises if the write failed.

        A query that waits for its next interval cannot be hurried, so it is
        replaced by one that drains the source from the same checkpoint.
        """
        self.stop()
        self._start(replace(self.options, interval=None)).awaitTermination()
        if self.options.interval is not None:
            self.query = self._start(self.options)

    def stop(self) -> None:
        self.query.stop()
        if self.query.exception() is not None:
            raise self.query.exception()

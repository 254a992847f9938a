"""Documents in blocks, and numbers of documents' parts dealt out to bins.

A block is one row that holds some documents as a compressed Arrow stream, so a
shuffle moves few large rows.  What numpy finds in a block is dealt to bins of
bounded size by (bin, block, data); a bin answers each block by (block, data).
One number weighs one entry per block that has it, however often it occurs there.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.llm.common import column, cut, partitions, prepare

BLOCK_BYTES = 4 << 20  # of texts before compression; one longer text is a block of its own
DEALT = "bin long, block long, data binary"
ANSWERED = "block long, data binary"


def blocks(given: DataFrame, label: str) -> DataFrame:
    """A written table (block, size, data): the rows of ``given``, some in each block.

    The numbers of blocks are random and stay the same as they are written once.
    """
    prepare(given.sparkSession)

    def packed(held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for batch in held:
                out.write_batch(batch)
        data = [[int.from_bytes(os.urandom(8), "little") >> 1], [size], [sink.getvalue().to_pybytes()]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(data, (pa.int64(), pa.int64(), pa.binary()))], ["block", "size", "data"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= BLOCK_BYTES:
                yield packed(held, size)
                held, size = [], 0
        if held:
            yield packed(held, size)

    return cut(given.mapInArrow(run, "block long, size long, data binary"), label)


def opened(data: bytes) -> pa.Table:
    """The rows of a block."""
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def joined_bytes(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column one after the other, and where each text begins (and the end of the last)."""
    chunks = [c for c in texts.chunks if len(c)]
    lengths = [np.diff(np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]) for c in chunks]
    parts = []
    for c in chunks:
        ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        parts.append(np.frombuffer(c.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]])
    flat = parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint8)])
    return flat, np.concatenate([[0], np.cumsum(np.concatenate([*lengths, np.zeros(0, np.int32)]), dtype=np.int64)])


def bins_for(table: DataFrame, bin_bytes: int) -> int:
    """How many bins: a multiple of the partitions, each for about ``bin_bytes`` of text at most."""
    tasks = partitions(table.sparkSession)
    total = table.agg(F.sum("size")).first()[0] or 0
    return tasks * max(1, -(-total // (bin_bytes * tasks)))


def in_bins(dealt: DataFrame, work: Callable[[list[int], list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Apply ``work`` to the blocks and data of each bin; it yields answers (block, data)."""
    tasks = partitions(dealt.sparkSession)
    rows = dealt.repartitionById(tasks, F.pmod("bin", F.lit(tasks)).cast("int")).sortWithinPartitions("bin")

    def answers(found: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        got = list(found)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.binary())], ["block", "data"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, numbers, held = None, [], []
        for batch in batches:
            bins = column(batch, "bin").to_pylist()
            for bin_, block, data in zip(bins, column(batch, "block").to_pylist(), column(batch, "data").to_pylist()):
                if bin_ != at and held:
                    yield from answers(work(numbers, held))
                    numbers, held = [], []
                at = bin_
                numbers.append(block)
                held.append(data)
        if held:
            yield from answers(work(numbers, held))
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, ANSWERED)


def with_answers(table: DataFrame, **answers: DataFrame) -> DataFrame:
    """Each block with the lists of the data it was answered, null where there are none."""
    out = table.select("block", "data")
    for name, rows in answers.items():
        lists = rows.groupBy("block").agg(F.collect_list("data").alias(name))  # bounded by the block's own size
        out = out.join(lists, "block", "left")
    return out


def over_rows(work: Callable[..., Iterator[pa.RecordBatch]], *names: str):
    """A function for ``mapInArrow`` that calls ``work`` with these columns of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from work(*[column(batch, n)[k].as_py() for n in names])
        pa.default_memory_pool().release_unused()

    return run


def dealt_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(3)], ["bin", "block", "data"])


# -- numbers of 48 bits ---------------------------------------------------------------


def pack48(numbers: np.ndarray) -> bytes:
    return np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def bin_of(numbers: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each 48-bit number; bins are ranges, so sorted numbers have sorted bins."""
    return ((numbers >> np.uint64(16)) * np.uint64(bins)) >> np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with all bits depending on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def among(numbers: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which numbers are in the sorted array ``known``?"""
    if not len(known):
        return np.zeros(len(numbers), bool)
    at = np.searchsorted(known, numbers)
    at[at == len(known)] = 0
    return known[at] == numbers


def counted_batch(block: int, keys: np.ndarray, counts: np.ndarray, bins: int) -> pa.RecordBatch:
    """A block's sorted numbers with their counts, dealt to bins; those that count one lie apart from the others."""
    bounds = np.searchsorted(bin_of(keys, bins), np.arange(bins + 1, dtype=np.uint64))
    rows = []
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        key, count = keys[bounds[k] : bounds[k + 1]], counts[bounds[k] : bounds[k + 1]]
        more = count > 1
        single = key[~more]
        rows.append((k, block, len(single).to_bytes(4, "little") + pack48(single) + pack48(key[more]) + count[more].astype("<u4").tobytes()))
    return dealt_batch(rows)


def frequent(dealt: DataFrame, min_count: int) -> DataFrame:
    """(block, data): the numbers of each block that count at least ``min_count`` over all blocks."""

    def work(numbers: list[int], held: list[bytes]) -> Iterator[tuple[int, bytes]]:
        keys, counts = [], []
        for data in held:
            single = int.from_bytes(data[:4], "little")
            at = 4 + 6 * single
            more = (len(data) - at) // 10
            keys += [unpack48(data[4:at]), unpack48(data[at : at + 6 * more])]
            counts += [np.ones(single, np.int64), np.frombuffer(data, "<u4", offset=at + 6 * more).astype(np.int64)]
        sizes = [len(a) + len(b) for a, b in zip(keys[::2], keys[1::2])]
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key)
        ranked = key[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        often = np.add.reduceat(count[order], first) >= min_count
        chosen = np.zeros(len(key), bool)
        chosen[order] = np.repeat(often, np.diff(np.concatenate([first, [len(key)]])))
        ends = np.cumsum(sizes)
        for block, end, size in zip(numbers, ends.tolist(), sizes):
            own = key[end - size : end][chosen[end - size : end]]
            if len(own):
                yield block, pack48(own)

    return in_bins(dealt, work)

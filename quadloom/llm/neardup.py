"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct five-word shingles (words: runs of other
characters than ASCII white space, A-Z in lower case; the whole sequence when
there are fewer words).  Documents with equal sets are one class; a class is
linked with another when 100 * intersection >= 75 * union.

* Each of 240 registers holds the truncated logarithm of the least of
  exponentially spaced values, here the value of the smallest of one hash over
  the set.  Registers of a union are the maxima of the registers of its parts.
* Five registers in a row are a band.  48 bands miss a pair at a similarity of
  0.75 with a probability of 2e-6, and more alike pairs hardly ever.
* Classes that share a band form clusters (connected components).  A cluster
  is compared in blocks: pairs of bounded parts, so that no task holds a large
  cluster and no pair is ever a row.
* Within a block, sizes and the joint likelihood of the registers discard
  pairs that are at least five deviations below the threshold; all others are
  confirmed on full sets of 64-bit hashes, unless already connected.

Null and empty texts and texts of white space have the empty set and no link.
Rows with one doc_id are one document.  A null doc_id has a null component and
is kept.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.common import by_batch, column, cut, prepare
from quadloom.llm.components import components

WORDS, REGISTERS, BAND = 5, 240, 5
PERCENT = 75
# Registers: base and rate of the exponential spacing, and the largest value.
BASE, RATE, TOP = 1.001, 20.0, 65_535
# Five deviations of the estimate at the threshold.
MARGIN = 5 * (0.75 * 0.25 / REGISTERS) ** 0.5
# Bounds of a part of a cluster: classes, and shingles of all of them.
PART_SETS, PART_SHINGLES = 1000, 500_000
CACHED = 50_000

_rng = np.random.default_rng(7)
_MIX = _rng.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_SCALE = _rng.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, REGISTERS, np.uint64)
_BANDING = _rng.integers(0, 1 << 63, BAND, np.uint64) * np.uint64(2) + np.uint64(1)
_words: dict[bytes, int] = {}


def _scramble(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a well-known 64-bit hash."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    if len(_words) > CACHED:
        _words.clear()
    known, out = _words, []
    for text in texts:
        words = text.encode().lower().split() if text else []
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.array([known[w] for w in words], np.uint64)
        if len(ids) >= n:
            last = len(ids) - n + 1
            mixed = sum((_scramble(ids[k : k + last] + _MIX[k]) * _MIX[k] for k in range(n)), np.uint64(0))
            out.append(np.unique(_scramble(mixed)))
        elif words:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers of a set that isn't empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for k in range(0, len(shingles), 512):
        np.minimum(least, (shingles[k : k + 512, None] * _SCALE + _SHIFT).min(0), out=least)
    spaced = -np.log1p(-np.minimum((least.astype(float) + 0.5) / 2.0**64, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(spaced) / np.log(BASE)), 0, TOP).astype(np.uint16)


def likely(equal: np.ndarray, above: np.ndarray, n: int, others: np.ndarray) -> np.ndarray:
    """Similarity of a set of ``n`` to others by joint likelihood.

    ``equal`` and ``above`` count the registers of the first that are equal to and above those of each other set.
    """
    grid = np.linspace(0.005, 0.995, 100)[None, :]
    u = (n / (n + others))[:, None]
    v = 1 - u
    j = np.minimum(grid, np.minimum(u / v, v / u) * 0.999)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    # of the registers' joint distribution: the probabilities that one or the other is above
    up, down = p(np.maximum(u - v * j, 1e-9)), p(np.maximum(v - u * j, 1e-9))
    # shares of the union of two sets that only one has, and both
    same = np.maximum(1 - up - down, 1e-9)
    below = REGISTERS - equal - above
    score = above[:, None] * np.log(up) + below[:, None] * np.log(down) + equal[:, None] * np.log(same)
    return j[np.arange(len(j)), score.argmax(1)]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, c1 and c2 (128 bits of the set) and registers; null keys and registers for the empty set."""
    prepare(docs.sparkSession)

    def work(batch):
        sets = shingle_sets(column(batch, "text").to_pylist())
        keys = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
        return {
            "doc_id": column(batch, "doc_id"),
            "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
            "c1": pa.array([k and int.from_bytes(k[:8], "little", signed=True) for k in keys], pa.int64()),
            "c2": pa.array([k and int.from_bytes(k[8:], "little", signed=True) for k in keys], pa.int64()),
            "registers": pa.array([registers(x).tobytes() if len(x) else None for x in sets], pa.binary()),
        }

    given = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return given.mapInArrow(by_batch(work), "doc_id long, n_shingles long, c1 long, c2 long, registers binary")


def bands(classes: DataFrame) -> DataFrame:
    """key and rep: a row for each band of each class."""
    count = REGISTERS // BAND

    def work(batch):
        held = np.frombuffer(b"".join(column(batch, "registers").to_pylist()), np.uint16).reshape(-1, count, BAND)
        mixed = (_scramble(held.astype(np.uint64) + _BANDING) * _BANDING).sum(2, dtype=np.uint64)
        keys = _scramble(mixed + np.arange(count, dtype=np.uint64) * _BANDING[0])
        rep = np.repeat(column(batch, "rep").to_numpy(zero_copy_only=False), count)
        return {"key": pa.array(keys.ravel().view(np.int64)), "rep": pa.array(rep)}

    return classes.select("rep", "registers").mapInArrow(by_batch(work), "key long, rep long")


def confirmed(held: list[np.ndarray], regs: np.ndarray, ids: np.ndarray, part: np.ndarray, across: bool) -> list[tuple[int, int]]:
    """Links between sets, as many as connect them: of one part, or between two parts if ``across``."""
    n = np.array([len(x) for x in held])
    flat, where = np.concatenate(held), np.cumsum(n) - n
    dense = np.unique(flat, return_inverse=True)[1]
    rows = [dense[w : w + k] for w, k in zip(where, n)]
    root = list(range(len(held)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    mark = np.zeros(int(dense.max()) + 1, bool)
    for a in range(len(held) - 1):
        rest = np.arange(a + 1, len(held))
        small, large = np.minimum(n[a], n[rest]), np.maximum(n[a], n[rest])
        fits = 100 * small >= PERCENT * large
        rest = rest[fits & (part[rest] != part[a]) if across else fits]
        if not len(rest):
            continue
        equal = (regs[rest] == regs[a]).sum(1)
        hopeful = equal >= REGISTERS * (PERCENT / 100 - 2 * MARGIN)
        rest, equal = rest[hopeful], equal[hopeful]
        if not len(rest):
            continue
        above = (regs[rest] < regs[a]).sum(1)
        guess = likely(equal, above, int(n[a]), n[rest])
        order = np.argsort(-guess, kind="stable")
        mark[rows[a]] = True
        for k in order[guess[order] >= PERCENT / 100 - MARGIN]:
            b = int(rest[k])
            if find(a) != find(b):
                both = int(np.count_nonzero(mark[rows[b]]))
                if 100 * both >= PERCENT * (int(n[a]) + int(n[b]) - both):
                    root[find(b)] = find(a)
                    out.append((int(ids[a]), int(ids[b])))
        mark[rows[a]] = False
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of cluster and pair of parts: one pair of parts at a time."""
    key, group = None, []

    def links() -> pa.RecordBatch:
        sets = [np.frombuffer(x[1], np.uint64) for x in group]
        regs = np.frombuffer(b"".join(x[2] for x in group), np.uint16).reshape(len(group), -1)
        ids, part = np.array([x[0] for x in group]), np.array([x[3] for x in group])
        found = confirmed(sets, regs, ids, part, key[1] != key[2]) if len(group) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    for batch in batches:
        for row in batch.to_pylist():
            now = (row["cluster"], row["i"], row["j"])
            if now != key:
                if group:
                    yield links()
                key, group = now, []
            if not group or group[-1][0] != row["rep"] or group[-1][1] != row["shingles"]:  # repeated rows
                group.append((row["rep"], row["shingles"], row["registers"], row["part"]))
    if group:
        yield links()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, for every row of ``docs``."""
    drawn = cut(sketches(docs), "sketches")
    classes = drawn.where("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"))
    classes = cut(classes, "classes")
    heads = drawn.join(classes, (drawn["doc_id"] == classes["rep"]) & (drawn["c1"] == classes["c1"]) & (drawn["c2"] == classes["c2"]))
    heads = cut(heads.select("rep", drawn["c1"], "n_shingles", "registers").dropDuplicates(["rep", "c1"]), "registers")

    banded = bands(heads)
    hubs = banded.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last").select("key", "hub")
    stars = banded.join(hubs, "key").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    clusters = components(stars, "clusters").withColumnRenamed("node", "rep").withColumnRenamed("component", "cluster")

    members = heads.join(clusters, "rep")
    parts = members.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / PART_SETS, F.sum("n_shingles") / PART_SHINGLES)).cast("int").alias("parts")
    )
    placed = members.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int"))

    def work(batch):
        sets = shingle_sets(column(batch, "text").to_pylist())
        keys = [int.from_bytes(xxhash.xxh3_128_digest(x.tobytes())[:8], "little", signed=True) for x in sets]
        # rows with one doc_id and another text stay out
        mine = pa.array([k == c for k, c in zip(keys, column(batch, "c1").to_pylist())])
        out = {"shingles": pa.array([x.tobytes() for x in sets], pa.binary())}
        out = {c: column(batch, c) for c in ("rep", "c1", "cluster", "parts", "part", "registers")} | out
        return {c: x.filter(mine) for c, x in out.items()}

    texts = docs.selectExpr("cast(doc_id as bigint) as rep", "cast(text as string) as text").where("rep is not null")
    given = texts.join(placed, "rep").select("rep", "c1", "cluster", "parts", "part", "registers", "text")
    full = given.mapInArrow(by_batch(work), "rep long, c1 long, cluster long, parts int, part int, registers binary, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = full.withColumn("other", other).withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    dealt = dealt.drop("parts", "other").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "rep", "c1")
    links = dealt.mapInArrow(_compare, "a long, b long")

    joined = components(links, "links").withColumnRenamed("node", "rep")
    by_class = classes.join(joined, "rep", "left").select("c1", "c2", F.coalesce("component", "rep").alias("component_id"))
    # rows with one doc_id and different texts: the smallest component of any of them is the component of all
    rows = drawn.select("doc_id", "n_shingles", "c1", "c2").join(by_class, ["c1", "c2"], "left")
    component = F.coalesce("component_id", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, one per doc_id, with all their columns; rows with a null doc_id stay."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    found = docs.join(kept, F.col("doc_id") == F.col("_kept"), "left_semi")
    # rows with one doc_id are together already
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    once = found.withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")
    return once.unionByName(docs.where("doc_id is null"))

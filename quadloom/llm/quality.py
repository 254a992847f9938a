"""Document quality by co-training on two views.

One classifier sees the text (letters, symbols, repetitions), the other one the
metadata of the document (language, source, size and layout).  Both learn from
the same labelled documents; in every round each one passes the unlabelled
documents it is surest about, with its labels, on to the other.  In the end both
are calibrated on the labelled documents, and a small regression combines them.

Learnt from: at most ``LABELLED`` labelled and ``POOL`` unlabelled documents, none
of them held out, chosen by a hash of doc_id.  All texts are scored whole.  Nulls
count as an empty text, an unknown language or source, and no length; missing
metadata columns as null.  Without labels of both kinds all scores are 1.
Repeated rows get the same score; one row of each doc_id is learnt from.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.llm.common import by_batch, column, filtered, prepare, values
from quadloom.llm.learning import held_out, logistic, platt, sample, sigmoid
from quadloom.llm.neardup import shingle_sets

LABELLED, POOL = 8_000, 4_000
ROUNDS, PASSED = 4, 100  # rounds, and documents of each kind passed on per round
SURE = 0.95
BINS, HASHES = 12, 32
LIMIT = 0.5

# Classes of bytes.
_KINDS = np.zeros(256, np.int64)
for _kind, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:", b"!?", b"|", b"%&$#*@^~+=<>{}[]\\/_`"), 1):
    _KINDS[list(_bytes)] = _kind
_KINDS[128:] = 9
TEXT_FEATURES, METADATA_FEATURES = 17, 6


def text_view(texts: list[str | None]) -> np.ndarray:
    """Shares of kinds of characters, of repeated words, passages and lines, and sizes of words and sentences."""
    out = np.zeros((len(texts), TEXT_FEATURES), np.float32)
    for row, (text, shingles) in enumerate(zip(texts, shingle_sets(texts))):
        if not text:
            continue
        raw = text.encode()
        kinds = np.bincount(_KINDS, weights=np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=10)
        n = len(raw)
        letters = kinds[1] + kinds[2] + kinds[9]
        words = raw.lower().split()
        count = max(1, len(words))
        lines = [x for x in raw.split(b"\n") if x]
        out[row] = [
            kinds[1] / max(1, letters), kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n, kinds[7] / n, kinds[8] / n,
            kinds[0] / n, letters / n, n / count, len(set(words)) / count ** 0.9,
            sum(map(eq, words, words[1:])) / count,
            1 - len(shingles) / max(1, len(words) - 4) if len(words) > 4 else 0.0,
            1 - len(set(lines)) / max(1, len(lines)),
            kinds[5] / count, kinds[6] / count, np.log1p(count),
        ]
    return out


def metadata_view(langs: list, sources: list, sizes: list, texts: list[str | None]) -> np.ndarray:
    """Size and layout as numbers, then language and source as numbers of their own."""
    out = np.zeros((len(texts), METADATA_FEATURES), np.float32)
    for row, (lang, source, size, text) in enumerate(zip(langs, sources, sizes, texts)):
        lines = text.count("\n") + 1 if text else 0
        out[row] = [
            np.log1p(max(0, size or 0)), np.log1p(lines), (len(text) if text else 0) / max(1, lines),
            np.log1p(len(text) if text else 0) - np.log1p(max(0, size or 0)),
            zlib.crc32(str(lang).encode()) % HASHES, zlib.crc32(b"s" + str(source).encode()) % HASHES,
        ]
    return out


@dataclass
class View:
    """A logistic regression over bins; the last ``names`` columns hold numbers of names."""

    names: int
    edges: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None

    def bins(self, x: np.ndarray) -> np.ndarray:
        numbers = x.shape[1] - self.names
        at = [np.searchsorted(self.edges[c], x[:, c], side="right") + c * BINS for c in range(numbers)]
        at += [x[:, numbers + k].astype(int) + numbers * BINS + k * HASHES for k in range(self.names)]
        one = np.zeros((len(x), 1 + numbers * BINS + self.names * HASHES))
        one[:, 0] = 1
        for a in at:
            one[np.arange(len(x)), 1 + a] = 1
        return one

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        numbers = x.shape[1] - self.names
        self.edges = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, BINS + 1)[1:-1])) for c in range(numbers)]
        pos = max(1.0, y.sum())
        balance = np.where(y > 0, 0.5 * len(y) / pos, 0.5 * len(y) / max(1.0, len(y) - pos))
        self.weights = logistic(self.bins(x), y, balance, 1.0)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.bins(x) @ self.weights


@dataclass
class Model:
    views: list[View]
    scales: list[tuple[float, float]]
    mix: np.ndarray | None  # offset and weight of each view's log-odds; None: nothing was learnt

    def odds(self, xs: list[np.ndarray]) -> np.ndarray:
        return np.stack([slope * v.raw(x) + offset for v, x, (slope, offset) in zip(self.views, xs, self.scales)], 1)

    def score(self, xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The combined score, and the calibrated score of each view."""
        if self.mix is None:
            return np.ones(len(xs[0])), np.ones((len(xs[0]), 2))
        odds = self.odds(xs)
        return sigmoid(self.mix[0] + np.clip(odds, -8, 8) @ self.mix[1:]), sigmoid(odds)


def learn(xs: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray]) -> Model:
    """Co-training on labelled rows ``xs`` (one array per view) and unlabelled rows ``pool``."""
    views = [View(0), View(2)]
    if not len(y) or y.min() == y.max():
        return Model(views, [], None)
    own = [(x, y) for x in xs]
    free = np.ones((2, len(pool[0])), bool)  # rows that a view hasn't been given yet
    for _ in range(ROUNDS):
        for view, (x, target) in zip(views, own):
            view.fit(x, target)
        gifts = []
        for k, view in enumerate(views):
            scale = platt(view.raw(xs[k]), y)
            sure = sigmoid(scale[0] * view.raw(pool[k]) + scale[1]) if len(pool[k]) else np.zeros(0)
            other = 1 - k
            order = np.argsort(sure, kind="stable")
            low = [i for i in order if sure[i] <= 1 - SURE and free[other, i]][:PASSED]
            high = [i for i in order[::-1] if sure[i] >= SURE and free[other, i]][:PASSED]
            gifts.append((other, np.array(low + high, int), np.array([0.0] * len(low) + [1.0] * len(high))))
        for other, rows, target in gifts:
            free[other, rows] = False
            own[other] = (np.concatenate([own[other][0], pool[other][rows]]), np.concatenate([own[other][1], target]))
    for view, (x, target) in zip(views, own):
        view.fit(x, target)
    model = Model(views, [platt(v.raw(x), y) for v, x in zip(views, xs)], None)
    odds = np.clip(model.odds(xs), -8, 8)
    model.mix = logistic(np.column_stack([np.ones(len(y)), odds]), np.clip(y, 0.01, 0.99), np.ones(len(y)), 1.0)
    return model


def _given(docs: DataFrame) -> DataFrame:
    def optional(name: str, kind: str):
        return (F.col(f"`{name}`") if name in docs.columns else F.lit(None)).cast(kind).alias(name)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), optional("text", "string"), optional("lang", "string"), optional("source", "string"), optional("n_chars", "long"))


def _views(batch: pa.RecordBatch) -> list[np.ndarray]:
    texts = values(batch, "text")
    rest = (values(batch, c) for c in ("lang", "source", "n_chars"))
    return [text_view(texts), metadata_view(*rest, texts)]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on bounded samples of ``docs``, with what ``labels`` says of quality."""
    given = _given(docs).where("doc_id is not null")
    ids = given.where(~held_out(F.col("doc_id"))).select("doc_id").distinct()
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))

    def drawn(chosen: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
        def work(batch):
            x = np.concatenate(_views(batch), 1)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel(), pa.float32()), x.shape[1]).cast(pa.list_(pa.float32()))
            return {"doc_id": column(batch, "doc_id"), "quality": column(batch, "quality"), "x": flat}

        rows = given.join(chosen, "doc_id").select(*given.columns, "quality").mapInArrow(by_batch(work), "doc_id long, quality int, x array<float>")
        # one row per document, however many rows have its id: bounded by the sample
        got = rows.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).orderBy("doc_id").toArrow()
        x = np.array(got["x"].to_pylist(), np.float32).reshape(got.num_rows, TEXT_FEATURES + METADATA_FEATURES)
        return [x[:, :TEXT_FEATURES], x[:, TEXT_FEATURES:]], np.array(got["quality"].to_pylist(), float)

    xs, y = drawn(sample(known.join(ids, "doc_id"), LABELLED))
    pool, _ = drawn(sample(ids.join(known, "doc_id", "left_anti").withColumn("quality", F.lit(0)), POOL))
    return learn(xs, y, pool)


def score(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """doc_id, score, text_score, metadata_score, kept (0 or 1) and held_out for every row of ``docs``."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels))

    def work(batch):
        both, each = model.value.score(_views(batch))
        return {
            "doc_id": column(batch, "doc_id"),
            "score": pa.array(both, pa.float64()),
            "text_score": pa.array(each[:, 0], pa.float64()),
            "metadata_score": pa.array(each[:, 1], pa.float64()),
        }

    scored = _given(docs).mapInArrow(by_batch(work), "doc_id long, score double, text_score double, metadata_score double")
    return scored.select("*", (F.col("score") >= limit).cast("int").alias("kept"), held_out(F.col("doc_id")).alias("held_out"))


def keep_good(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all their columns."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels))
    return filtered(docs, lambda batch: pa.array(model.value.score(_views(batch))[0] >= limit))

"""Toxicity by non-negative positive-unlabelled learning.

A linear model over words and beginnings of words is learnt from confirmed toxic
documents and unlabelled ones.  Its risk is that of the positives plus that of
the unlabelled as negatives, less the share that the class prior ascribes to
positives among them; where this difference would fall below zero, the model
overfits and takes a step back.  The score is calibrated on the labelled rows.

Learnt from: at most ``POSITIVES`` toxic, ``UNLABELLED`` unlabelled and
``CHECKED`` labelled documents, none of them held out, chosen by a hash of
doc_id.  Of a document only its whole text counts.  Null and empty texts get the
score of a text without any known word.  Without toxic examples all scores are 0.
Repeated rows get the same score; one row of each doc_id is learnt from; other columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.llm.common import by_batch, column, filtered, prepare, values
from quadloom.llm.learning import held_out, platt, sample, sigmoid

POSITIVES, UNLABELLED, CHECKED = 4_000, 12_000, 8_000
BUCKETS = 1 << 20  # of feature hashes
FEATURES = 4_096  # features that are kept
LEAST = 3  # positives that a kept feature has
SURPLUS = 4.0  # deviations by which a feature is more frequent among positives
LIMIT = 0.3
CACHED = 50_000
AT_ONCE = 256  # rows whose features are handled together

_WORD = re.compile(r"[^\W\d_]+")
_features: dict[str, tuple[int, ...]] = {}


def features(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct hashes of each text's words and of their first four, five and six letters."""
    known, out = _features, []
    if len(known) > CACHED:
        known.clear()
    for text in texts:
        words = set(_WORD.findall(text.lower())) if text else set()
        for w in words.difference(known):
            known[w] = tuple(xxhash.xxh32_intdigest(f) % BUCKETS for f in (w, "4" + w[:4], "5" + w[:5], "6" + w[:6])[: max(1, min(4, len(w) - 2))])
        out.append(np.array(sorted({f for w in words for f in known[w]}), np.int32))
    return out


@dataclass
class Model:
    """``weights`` of the kept features, ascending in ``kept``."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    blank: bool = False

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        at, value = _csr(rows, self.kept)
        return self.bias + np.bincount(at, weights=self.weights[value], minlength=len(rows))

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.zeros(len(rows)) if self.blank else sigmoid(self.slope * self.raw(rows) + self.offset)


def _csr(rows: list[np.ndarray], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and positions in ``kept`` of the features that are kept."""
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for s in range(0, len(rows) if len(kept) else 0, AT_ONCE):
        some = rows[s : s + AT_ONCE]
        flat = np.concatenate(some)
        at = np.repeat(np.arange(s, s + len(some)), [len(r) for r in some])
        value = np.minimum(np.searchsorted(kept, flat), len(kept) - 1)
        found = kept[value] == flat
        parts.append((at[found], value[found]))
    at, value = (np.concatenate(x) for x in zip(*parts))
    return at, value


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    """How many rows have each feature."""
    total = np.zeros(BUCKETS, np.int64)
    for s in range(0, len(rows), AT_ONCE):
        total += np.bincount(np.concatenate(rows[s : s + AT_ONCE]), minlength=BUCKETS)
    return total


def learn(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 600, rate: float = 0.1, decay: float = 0.02) -> Model:
    """Linear model of least non-negative positive-unlabelled risk (logistic loss)."""
    n_p, n_u = len(positive), len(unlabelled)
    in_p, in_u = _counts(positive), _counts(unlabelled)
    # features clearly more frequent among positives than among all
    expected = in_u * (n_p / max(1, n_u))
    surplus = (in_p - expected) / np.sqrt(expected + 0.5)
    clear = (in_p >= LEAST) & (surplus >= SURPLUS) & (in_p >= 2 * expected)
    kept = np.sort(np.argsort(-np.where(clear, surplus, 0.0), kind="stable")[: min(FEATURES, int(clear.sum()))])
    p_at, p_value = _csr(positive, kept)
    u_at, u_value = _csr(unlabelled, kept)
    w, b = np.zeros(len(kept)), 0.0
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1):
        s_p = b + np.bincount(p_at, weights=w[p_value], minlength=n_p)
        s_u = b + np.bincount(u_at, weights=w[u_value], minlength=n_u)
        as_negative = np.logaddexp(0, s_u).mean() - prior * np.logaddexp(0, s_p).mean()
        # slopes of the losses with regard to the scores
        g_p = -prior * (1 - sigmoid(s_p)) / n_p
        low_p, low_u = -prior * sigmoid(s_p) / n_p, sigmoid(s_u) / max(1, n_u)
        if as_negative < 0:
            g_p, d_p, d_u = np.zeros(n_p), -low_p, -low_u
        else:
            d_p, d_u = low_p, low_u
        d_p = d_p + g_p
        slope = np.bincount(p_value, weights=d_p[p_at], minlength=len(kept)) + np.bincount(u_value, weights=d_u[u_at], minlength=len(kept))
        slope = np.append(slope + decay * w / max(1, len(kept)), d_p.sum() + d_u.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(kept, w, float(b))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on bounded samples of ``docs``, with what ``labels`` says of toxicity."""
    given = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").where("doc_id is not null")
    known = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = given.where(~held_out(F.col("doc_id"))).select("doc_id").distinct()

    def drawn(chosen: DataFrame, wanted: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        def work(batch):
            found = features(column(batch, "text").to_pylist())
            if wanted is not None:
                found = [x[wanted[x]] for x in found]
            return {"doc_id": column(batch, "doc_id"), "toxic": column(batch, "toxic"), "f": pa.array([x.tobytes() for x in found], pa.binary())}

        rows = given.join(chosen, "doc_id").select("doc_id", "text", "toxic").mapInArrow(by_batch(work), "doc_id long, toxic int, f binary")
        # one row per document, however many rows have its id: bounded by the sample
        got = rows.groupBy("doc_id", "toxic").agg(F.min("f").alias("f")).toArrow()
        order = np.argsort(np.array(got["doc_id"]), kind="stable")  # one label of each document
        found = [np.frombuffer(got["f"][k].as_buffer(), np.int32) for k in order.tolist()]  # no copies
        return found, np.array(got["toxic"], float)[order]

    positive, _ = drawn(sample(known.where("toxic = 1").join(ids, "doc_id"), POSITIVES))
    if not positive:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, blank=True)
    # only features of some positives can be kept, so the others needn't be gathered
    wanted = _counts(positive) >= LEAST
    unlabelled, _ = drawn(sample(ids.withColumn("toxic", F.lit(0)), UNLABELLED), wanted)
    checked, y = drawn(sample(known.join(ids, "doc_id"), CHECKED), wanted)
    model = learn(positive, unlabelled, float(np.clip(y.mean(), 0.001, 0.9)))
    model.slope, model.offset = platt(model.raw(checked), y)
    return model


def score(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels))

    def work(batch):
        found = model.value.score(features(column(batch, "text").to_pylist()))
        return {"doc_id": column(batch, "doc_id"), "score": pa.array(found, pa.float64())}

    given = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    scored = given.mapInArrow(by_batch(work), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, with all their columns."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels))
    return filtered(docs, lambda batch: pa.array(model.value.score(features(values(batch, "text"))) < limit))

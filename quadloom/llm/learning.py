"""Small numpy models that the classifiers share, and the bounded samples they learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 12) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the first column of ``x`` isn't penalized."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w -= move * min(1.0, 5.0 / max(1e-9, float(np.abs(move).max())))
        if np.abs(move).max() < 1e-4:
            break
    return w


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn a score into a log-odds; targets are moved inwards as for small samples."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([np.ones(len(y)), score], 1)
    offset, slope = logistic(x, target, np.ones(len(y)), 1e-3, 30)
    return float(slope), float(offset)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by a hash of doc_id, the same on every run: small enough to broadcast."""
    return F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))

"""Small linear models trained on the driver from bounded samples, and the sampling of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F


def sample(labelled: DataFrame, name: str, per_class: int) -> DataFrame:
    """At most `per_class` rows of each value of the column `name`, those with the smallest hash of doc_id, as `draw`.

    One pass counts the classes and one draws: rows whose hash lies below a limit that leaves some
    more than `per_class` of each class, of which the first are taken. So what a window sorts is
    bounded by the classes, whatever their share of the table. Nulls are no class.
    """
    drawn = labelled.filter(F.col(name).isNotNull()).withColumn("draw", F.xxhash64("doc_id"))
    limits = drawn.groupBy(F.col(name).alias("_class")).agg(F.count("*").alias("_n"))
    limits = limits.select("_class", F.least(F.lit(1.0), (1.5 * per_class + 100) / F.col("_n")).alias("_limit"))
    share = F.pmod("draw", F.lit(1 << 32)) / float(1 << 32)
    near = drawn.join(F.broadcast(limits), F.col(name) == F.col("_class")).filter(share < F.col("_limit"))  # one row per class
    rank = F.row_number().over(W.partitionBy(name).orderBy(share, "draw", "doc_id"))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= per_class).drop("_class", "_limit", "_rank")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def platt(z: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and intercept that turn margins into probabilities (smoothed targets, Newton steps)."""
    up, down = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * z + b)
        g = np.array([((p - t) * z).sum(), (p - t).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
    return float(a), float(b)


def fit_sparse(
    index: np.ndarray,
    value: np.ndarray,
    row: np.ndarray,
    y: np.ndarray,
    size: int,
    rounds: int = 80,
    rate: float = 0.3,
    ridge: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Logistic regression over sparse rows (Adam on the whole sample; classes weighted alike)."""
    w, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    for k in range(1, rounds + 1):
        z = np.bincount(row, weights=w[index] * value, minlength=len(y)) + bias
        r = (sigmoid(z) - y) * weight
        g, gb = np.bincount(index, weights=value * r[row], minlength=size) + ridge * w, r.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        scale = np.sqrt(1 - 0.99**k) / (1 - 0.9**k)
        w -= rate * scale * m / (np.sqrt(v) + 1e-8)
        bias -= 0.1 * scale * mb / (np.sqrt(vb) + 1e-8)
    return w, float(bias)


def fit_dense(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = sigmoid(x @ w)
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        w -= np.clip(np.linalg.solve(h, x.T @ (p - y) + penalty * w), -3, 3)
    return w

"""Labelled rows for the classifiers: who may be learned from, and a bounded
sample of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS


def sample_ids(labels: DataFrame, id_col: str, label_cols: list[str], bound: int) -> DataFrame:
    """At most ``bound`` labelled ids outside the held-out fold, one row per
    id (of contradicting labels the larger), chosen by a hash of the id. Only
    the last label must be known."""
    one = (labels.where(F.col(id_col).isNotNull() & (fold(id_col) != 0))
           .groupBy(id_col).agg(*[F.max(c).alias(c) for c in label_cols]))
    known = one.dropna(subset=label_cols[-1:])
    return known.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(bound)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def newton_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression over a few dense columns; the weights."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w

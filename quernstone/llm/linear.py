"""Small linear models, fitted on the driver from bounded samples, and the sampling itself."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def adam(gradient, start: np.ndarray, rounds: int, rate: float) -> np.ndarray:
    """Full-batch Adam with a rate that falls to a tenth."""
    w, m, v = start.astype(np.float64), np.zeros(len(start)), np.zeros(len(start))
    for t in range(1, rounds + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * 0.1 ** (t / rounds) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


class Entries:
    """The entries of a matrix that is mostly zero."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.values, self.shape = rows, columns, values.astype(np.float64), shape

    def with_column(self, values: np.ndarray) -> Entries:
        """The matrix with one more, full column."""
        n, width = self.shape
        return Entries(np.concatenate([self.rows, np.arange(n)]), np.concatenate([self.columns, np.full(n, width)]), np.concatenate([self.values, values]), (n, width + 1))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * w[self.columns], self.shape[0])

    def turned_times(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * r[self.rows], self.shape[1])


class Dense:
    """Any other matrix."""

    def __init__(self, x: np.ndarray):
        self.x, self.shape = x, x.shape

    def times(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w

    def turned_times(self, r: np.ndarray) -> np.ndarray:
        return self.x.T @ r


def logistic(x: Entries | Dense, y: np.ndarray, ridge: float = 1e-4, rounds: int = 200, rate: float = 0.1, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression; the last is the intercept, which the ridge leaves alone."""
    share = np.full(len(y), 1 / max(len(y), 1)) if weight is None else weight / weight.sum()

    def gradient(w):
        r = (sigmoid(x.times(w[:-1]) + w[-1]) - y) * share
        return np.append(x.turned_times(r) + ridge * w[:-1], r.sum())

    return adam(gradient, np.zeros(x.shape[1] + 1), rounds, rate)


def crc_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus))


#: Hashes that decide about a sample are below this.
SPREAD = 1 << 30


def smallest_hashes(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` of the rows, whose key is unique: those with the smallest hashes of it.

    A threshold from the number of rows comes first, so that no task sends on ``most`` rows of its own.
    """
    own = F.pmod(F.xxhash64(key), F.lit(SPREAD))
    n = rows.count()
    if n > 2 * most:
        rows = rows.filter(own < int(SPREAD * min(1.0, (1.25 * most + 1000) / n)))
    return rows.orderBy(own, key).limit(most)


def sampled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One text of each chosen id, with the columns of ``chosen`` (doc_id and more): the text with the smallest hash.

    ``chosen`` is a bounded sample and is broadcast; a repeated id counts once, however many rows it has.
    """
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id")
    picked = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return picked.join(F.broadcast(chosen), "doc_id")

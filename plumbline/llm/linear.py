"""Logistic regression on sparse rows of a bounded sample, and bounded samples by id."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Sparse:
    """Entries (row, column, value) of ``n`` rows, with any number of dense columns behind."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    n: int

    def take(self, rows: np.ndarray) -> Sparse:
        """The rows where the mask holds, numbered anew."""
        number = np.cumsum(rows) - 1
        keep = rows[self.row]
        return Sparse(number[self.row[keep]], self.column[keep], self.value[keep], int(rows.sum()))

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], minlength=self.n)


@dataclass
class Linear:
    weights: np.ndarray
    dense: np.ndarray
    bias: float

    def probability(self, sparse: Sparse, dense: np.ndarray) -> np.ndarray:
        return sigmoid(sparse.times(self.weights) + dense @ self.dense + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(
    sparse: Sparse, dense: np.ndarray, target: np.ndarray, columns: int, *, l1: float = 0.0, l2: float = 1e-4,
    rounds: int = 300,
) -> Linear:
    """Least penalised log loss against targets from 0 to 1, by accelerated proximal gradient steps.

    With targets that are all the same the model is constant.
    """
    mean = float(np.clip(target.mean(), 1e-6, 1 - 1e-6)) if len(target) else 1e-6
    k = dense.shape[1]
    start = np.zeros(columns + k + 1)
    start[-1] = np.log(mean / (1 - mean))
    if not len(target) or target.min() == target.max():
        return Linear(start[:columns], start[columns:-1], float(start[-1]))

    def forward(w: np.ndarray) -> np.ndarray:
        return sparse.times(w) + dense @ w[columns:-1] + w[-1]

    def back(r: np.ndarray) -> np.ndarray:
        own = np.bincount(sparse.column, sparse.value * r[sparse.row], minlength=columns)
        return np.concatenate([own, dense.T @ r, [r.sum()]])

    v = np.ones(len(start))
    size = 1.0
    for _ in range(20):  # largest eigenvalue, for the step
        v = back(forward(v / size))
        size = float(np.linalg.norm(v))
    n = len(target)
    step = 1 / (0.25 * 1.1 * size / n + l2)
    penalty = np.full(len(start), l2)
    penalty[-1] = 0
    shrink = np.full(len(start), step * l1)
    shrink[columns:] = 0  # only the sparse columns are to be few
    w, ahead, t = start.copy(), start.copy(), 1.0
    for _ in range(rounds):
        new = ahead - step * (back(sigmoid(forward(ahead)) - target) / n + penalty * ahead)
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        if (ahead - new) @ (new - w) > 0:  # momentum that leads uphill starts anew
            t = 1.0
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return Linear(w[:columns], w[columns:-1], float(w[-1]))


def sample_by_id(rows: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows with an id, chosen by the hash of ``id``; the same at every run."""
    order = F.xxhash64("id")
    return rows.where("id IS NOT NULL").orderBy(order, "id").limit(size)


def at_most(rows: DataFrame, size: int) -> DataFrame:
    """The rows, with columns id and text; where ids are shared by so many that there are more than ``size``, those
    with the smallest hashes of both, and of equal rows at the end of these one."""
    if rows.select("id").count() <= size:
        return rows
    keyed = rows.withColumn("key", F.xxhash64("id", "text"))
    cut = keyed.select("key").orderBy("key").limit(size).agg(F.max("key")).head()[0]
    return keyed.where(F.col("key") < cut).union(keyed.where(F.col("key") == cut).limit(1)).drop("key")

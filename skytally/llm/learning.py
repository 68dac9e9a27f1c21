"""Labelled samples and a small optimizer for the models trained here."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bucket

FOLDS = 3
HELD_OUT = 1


def held_out():
    """Rows that no label is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.pmod(bucket(), F.lit(FOLDS)) == HELD_OUT


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """doc_id, text and y (0/1) of at most ``per_class`` labelled documents of each class.

    Only rows outside the held-out fold; those with the smallest hashes of
    their ids are taken, so the sample is the same on every run.  A document with
    several labels has the largest; null labels and null ids are left out.
    ``2 * per_class`` ids bound what is broadcast.
    """
    y = (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
         .groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y")))
    ids = None
    for value in (0, 1):
        own = y.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = own if ids is None else ids.unionByName(own)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01, decay: float = 1e-4):
        self.p, self.rate, self.decay, self.t = params, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            g = g + self.decay * self.p[k]
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))

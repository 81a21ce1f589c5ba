"""Follow-the-regularised-leader for sparse linear models, and the sampling
of labelled rows they are fitted on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Ftrl:
    """Per-coordinate FTRL-proximal with elastic-net penalties over a
    (features, classes) weight matrix."""

    def __init__(self, features: int, classes: int, alpha: float, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0):
        self.z = np.zeros((features, classes), dtype=np.float64)
        self.n = np.zeros((features, classes), dtype=np.float64)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, idx=slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        shrunk = z - np.clip(z, -self.l1, self.l1)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, idx: np.ndarray, w: np.ndarray, gradient: np.ndarray) -> None:
        """One step from weights ``w`` of the distinct features ``idx``."""
        n = self.n[idx]
        grown = n + gradient * gradient
        self.z[idx] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[idx] = grown


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def unit(*cols: Column) -> Column:
    """A number in [0, 1) fixed by the columns' values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, mod n (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def sample_classes(rows: DataFrame, label: str, per_class: int, key: list[str]) -> DataFrame:
    """About ``per_class`` rows of each label (all rows of rarer labels),
    chosen by a hash of the ``key`` columns.  One count per label goes to
    the driver."""
    counts = rows.groupBy(label).count().collect()
    rate = F.lit(0.0)
    for value, n in counts:
        rate = F.when(F.col(label) == F.lit(value), F.lit(per_class / n)).otherwise(rate)
    return rows.where(unit(F.lit(len(key)), *[F.col(c) for c in key]) < rate)

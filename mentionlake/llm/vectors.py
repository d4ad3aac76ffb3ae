"""Usable vectors of a table, and their p-stable projections."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SEED = 20_240


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of vectors with finite components that are not all zero, one row per id.

    Rows without an id take no part; of several vectors of one id the least (as an array) counts.
    """
    finite = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
        .where(finite & F.exists("vec", lambda x: x != 0))
        .groupBy("id").agg(F.min("vec").alias("vec"))
    )


def matrices(batch: pa.RecordBatch, column: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each dimension that occurs in a list column without nulls."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(np.r_[0, sizes])[:-1]
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((rows, values[starts[rows][:, None] + np.arange(d)]))
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms, also of very large and very small components."""
    top = np.abs(x).max(axis=1)
    return np.sqrt(((x / top[:, None]) ** 2).sum(axis=1)) * top


def projections(dimension: int, count: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and offsets; the same for everyone who asks."""
    rng = np.random.default_rng((SEED, dimension, count))
    return rng.normal(size=(dimension, count)), rng.uniform(0, width, count)


_GRID = np.linspace(-8, 8, 6401)
_NORMAL = np.array([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in _GRID])


def normal(x: np.ndarray) -> np.ndarray:
    """Distribution function of the standard normal."""
    return np.interp(x, _GRID, _NORMAL, 0.0, 1.0)

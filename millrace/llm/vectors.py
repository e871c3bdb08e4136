"""Embedding columns as exact integer vectors, and exact sums over them."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integers up to here stay exact in all steps; larger components are an error.
MOST = 1 << 60
EXACT_FLOAT = 1 << 53


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return F.coalesce(F.forall(vector, number), F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * c) of each component as a long; one beyond ``MOST`` is an error."""

    def of(c: Column) -> Column:
        whole = F.floor(c.cast("double") * scale)
        fits = F.abs(c.cast("double") * scale) < float(MOST)
        return F.when(fits, whole).otherwise(F.raise_error(F.lit("a vector's component is too large for exact numbers")).cast("bigint"))

    return F.transform(vector, of)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min()), 1) if x.size else 1


def roomy(x: np.ndarray, most: int) -> np.ndarray:
    """As they are, or as Python's whole numbers where a result may pass 2**63."""
    return x if most < 1 << 62 else x.astype(object)


def products(u: np.ndarray) -> np.ndarray:
    """The exact sum of the outer products of the rows, as Python's whole numbers.

    Blocks whose sums stay below 2**53 go through floating-point matrix products.
    """
    total = np.zeros((u.shape[1], u.shape[1]), object)
    most = largest(u) ** 2
    if most >= EXACT_FLOAT:
        whole = u.astype(object)
        return whole.T @ whole
    step = max(1, (EXACT_FLOAT - 1) // most)
    for lo in range(0, len(u), step):
        block = u[lo : lo + step].astype(np.float64)
        total += (block.T @ block).astype(np.int64).astype(object)
    return total


def decimals(values) -> pa.Array:
    """Whole numbers of any kind as decimals of 38 digits."""
    values = np.asarray(values)
    if values.dtype != object:
        return pa.array(values, pa.int64()).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def counted(rows: DataFrame, keys: list[str], value: str) -> dict[tuple, int]:
    """Sums by key of the rows that the tasks made, as whole numbers; the keys are few."""
    found = rows.groupBy(*keys).agg(F.sum(value).alias("_sum")).collect()
    return {tuple(r[k] for k in keys): int(r["_sum"]) for r in found}

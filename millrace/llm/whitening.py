"""Whitening of embeddings by exact principal components.

Entries become whole numbers x = floor(scale * c). The fit list is each distinct x vector
once, so copies count once however many there are. Tasks send exact sums and, after the
centre is known, exact sums of products of the centred numbers; n times these less the products of the
rest give n * n times the covariance as whole numbers. Its characteristic polynomial, the
largest roots and their vectors are found exactly or in many digits (see ``charpoly``), and each
row's deviation and projections are computed in tasks.

What reaches the driver is the matrix (``dims`` squared numbers, at most ``MOST_DIMS``) and for each
prime the polynomial modulo it, whatever the number of rows.

Defined cases: vectors that are missing or hold missing or non-finite entries are left out; of several lengths the most
frequent one counts (of equally frequent ones the larger), others are left out; a missing key is kept;
repeated rows each get their result; components with no variance are left out, so a table with fewer than two
distinct vectors gives no rows; columns other than key and vector play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.charpoly import characteristic_polynomial, eigenvectors, largest_roots
from millrace.llm.vectors import counted, decimals, finite, floored, largest, matrix, products, roomy
from millrace.session import written

MOST_DIMS = 512
BLOCK_ROWS = 2048


@dataclass(frozen=True)
class Components:
    """What is fitted: n vectors with sums S, and the components by falling variance."""

    n: int
    sums: list[int]
    vectors: list[list[float]]
    variances: list[float]
    explained: list[float]
    scale: int


def _moments(fit: DataFrame, dims: int, centre: list[int] | None) -> dict[tuple, int]:
    """Exact sums by (i, j): (-1, -1) the rows, (i, -1) the numbers less the centre, and with a centre (i, j) their products."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            x = matrix(batch.column(0), dims)
            u = x if centre is None else x - np.array(centre, np.int64)
            n += len(u)
            sums += roomy(u, largest(u) * max(len(u), 1)).sum(axis=0).astype(object)
            if centre is not None and len(u):
                total += products(u)
        i, j = np.triu_indices(dims) if centre is not None else (np.zeros(0, int), np.zeros(0, int))
        at = [np.concatenate([[-1], np.arange(dims), i]), np.concatenate([[-1], np.full(dims, -1), j])]
        values = np.concatenate([np.array([n], object), sums, total[i, j]])
        yield pa.RecordBatch.from_arrays([*(pa.array(a, pa.int32()) for a in at), decimals(values)], ["i", "j", "v"])

    return counted(fit.mapInArrow(summed, "i int, j int, v decimal(38,0)"), ["i", "j"], "v")


def scatter(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S, and n * n times the covariance, all exact."""
    found = _moments(fit, dims, None)
    n, sums = found.get((-1, -1), 0), [found.get((i, -1), 0) for i in range(dims)]
    a = np.zeros((dims, dims), object)
    if n:
        found = _moments(fit, dims, [s // n for s in sums])
        for i in range(dims):
            for j in range(i, dims):
                a[i, j] = a[j, i] = n * found[i, j] - found[i, -1] * found[j, -1]
    return n, sums, a


def fit_components(fit: DataFrame, dims: int, count: int, scale: int) -> Components:
    n, sums, a = scatter(fit, dims)
    common = math.gcd(*(int(v) for v in a.ravel())) or 1
    reduced = a // common
    if not np.any(reduced):
        return Components(n, sums, [], [], [], scale)
    roots, shift = largest_roots(characteristic_polynomial(fit.sparkSession, reduced), count)
    exact = [Fraction(2 * g + 1, 2 << shift) * common for g in roots]
    return Components(
        n,
        sums,
        eigenvectors(reduced, roots, shift),
        [float(e / n**2) for e in exact],
        [float(e / int(np.trace(a))) for e in exact],
        scale,
    )


def _projected(x: np.ndarray, fitted: Components) -> tuple[np.ndarray, np.ndarray]:
    """(whitened, n * x - S) of each row."""
    most = fitted.n * largest(x) + max(map(abs, fitted.sums))
    off = roomy(x, most) * fitted.n - np.array(fitted.sums, object if most >= 1 << 62 else np.int64)
    centred = (off / fitted.n).astype(np.float64)
    return centred @ np.array(fitted.vectors).T / np.sqrt(fitted.variances), off


def identity_error(fit: DataFrame, fitted: Components, dims: int) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    r = len(fitted.vectors)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((r + 1, r))
        for batch in batches:
            w, _ = _projected(matrix(batch.column(0), dims), fitted)
            total[:r] += w.T @ w
            total[r] += w.sum(axis=0)
        i, j = np.divmod(np.arange(total.size), r)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    rows = fit.mapInArrow(summed, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((r + 1, r))
    for row in rows:
        total[row["i"], row["j"]] = row["v"]
    mean = total[r] / fitted.n
    return float(np.abs(total[:r] / fitted.n - np.outer(mean, mean) - np.eye(r)).max())


def whiten(rows: DataFrame, components: int = 4, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): each kept row projected on the largest components.

    ``deviation`` is the exact sum of (n * x - S) squared, a decimal of 38 digits.
    """
    kept = rows.where(finite(F.col(vector))).select(F.col(key).alias("key"), floored(F.col(vector), scale).alias("x"))
    kind = kept.schema["key"].dataType.simpleString()
    lengths = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    dims = most[0]["d"] if most else 0
    if dims > MOST_DIMS:
        raise ValueError(f"vectors of {dims} entries: the exact polynomial is offered up to {MOST_DIMS}")
    kept = kept.where(F.size("x") == dims)
    schema = f"key {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    names = lambda df: df.withColumnRenamed("key", key)
    fitted = Components(0, [], [], [], [], scale)
    if dims:
        fit = written(kept.select("x").distinct(), "fit-list")
        fitted = fit_components(fit, dims, components, scale)
    if not fitted.vectors:
        return names(rows.sparkSession.createDataFrame([], schema))
    error = identity_error(fit, fitted, dims)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                w, off = _projected(matrix(part.column(1), dims), fitted)
                off = roomy(off, largest(off) ** 2 * dims)
                lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), decimals((off * off).sum(axis=1)), lists], ["key", "deviation", "whitened"])

    found = kept.mapInArrow(project, f"key {kind}, deviation decimal(38,0), whitened array<double>")
    long = found.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return names(
        long.select(
            "key",
            (F.col("at") + 1).alias("component"),
            F.lit(fitted.n).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            F.element_at(F.array(*map(F.lit, fitted.explained)), F.col("at") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )

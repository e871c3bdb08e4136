"""Lloyd clustering of integer vectors with an exact Walsh-Hadamard progressive search.

Vectors and centroids are transformed by the integer matrix of +1 and -1, rows in the
order of their sign changes (coarse to fine). The transform keeps distances but for the
factor ``dims``, so the sum over the first coefficients is a lower bound of the distance.
A vector's leading centroid after the first coefficients is measured over all of them; a centroid
whose sum so far is strictly above that goes, and those left in the end are
measured over all ``dims`` coefficients. Ties go to the smaller number. All numbers are whole.

The transformed vectors are written once. A round reads them, and each task gives a count and sums
for each centroid, so k rows a task are shuffled and k rows reach the driver.

Defined cases: vectors that are missing, of another length, or hold missing or non-finite entries are left out; a missing key
is kept (its text is empty in the draw of the first centroids); rows that share a key are drawn in the
order of their vectors; fewer vectors than centroids give as many centroids; a table without vectors gives no
rows; columns other than key and vector play no part. Distances must fit into a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.vectors import decimals, finite, floored, largest, matrix, roomy
from millrace.session import written

COARSE = 16  # the first level is a sixteenth of the coefficients; each further one doubles them
BLOCK_ROWS = 2048


@dataclass(frozen=True)
class Clusters:
    count: int = 8
    rounds: int = 10
    scale: int = 1024
    seed: str = "3"
    dims: int = 64  # a power of two


@lru_cache
def _by_changes(dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The symmetric matrix of +1 and -1 built by doubling, and its rows by rising number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < dims:
        h = np.block([[h, h], [h, -h]])
    return h, np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


def walsh(dims: int) -> np.ndarray:
    """The matrix of the transform, coarse rows first."""
    h, order = _by_changes(dims)
    return h[order]


def transformed(x: np.ndarray) -> np.ndarray:
    """The coefficients of each row, by sums and differences of halves."""
    n, dims = x.shape
    y = roomy(x, largest(x) * dims).reshape(n, 1, dims)
    while (half := y.shape[2] // 2) >= 1:
        y = np.concatenate([y[:, :, :half] + y[:, :, half:], y[:, :, :half] - y[:, :, half:]], axis=2).reshape(n, dims // half, half)
    return y.reshape(n, dims)[:, _by_changes(dims)[1]]


def nearest(y: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid, both given by coefficients."""
    dims, k, n = y.shape[1], len(centroids), len(y)
    most = (largest(y) + largest(centroids)) ** 2 * dims
    y, centroids = roomy(y, most), roomy(centroids, most)

    def grown(r: np.ndarray, c: np.ndarray, lo: int, hi: int) -> np.ndarray:
        d = y[r, lo:hi] - centroids[c, lo:hi]
        return (d * d).sum(axis=1)

    rows = np.arange(n)
    r, c = np.repeat(rows, k), np.tile(np.arange(k), n)
    done = max(1, dims // COARSE)
    sums = grown(r, c, 0, done)
    lead = sums.reshape(n, k).argmin(axis=1)
    bound = sums[rows * k + lead] + grown(rows, lead, done, dims)
    while done < dims:
        lo, done = done, min(2 * done, dims)
        open_pairs = sums <= bound[r]
        r, c, sums = r[open_pairs], c[open_pairs], sums[open_pairs]
        sums = sums + grown(r, c, lo, done)
    # Pairs stand by row and centroid: the first of the least sums is the smaller number.
    order = np.lexsort((c, sums, r)) if sums.dtype != object else np.array(sorted(range(len(r)), key=lambda i: (r[i], sums[i], c[i])), int)
    first = order[np.searchsorted(r[order], rows)]
    return c[first], sums[first] // dims


def _assigned(batches: Iterator[pa.RecordBatch], coefficients: list[list[int]], dims: int):
    """(batch, rows, coefficients, centroid, distance) by blocks of rows."""
    c = np.array(coefficients, object)
    c = c.astype(np.int64) if largest(c) < 1 << 62 else c
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(lo, BLOCK_ROWS)
            y = matrix(part.column(1), dims)
            yield part, y, *nearest(y, c)


def _round(vectors: DataFrame, coefficients: list[list[int]], dims: int) -> dict[int, tuple[int, list[int]]]:
    """For each centroid with vectors, how many and the sums of their coefficients."""
    names = [f"s{i}" for i in range(dims)]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(coefficients)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), object)
        for _, y, at, _ in _assigned(batches, coefficients, dims):
            counts += np.bincount(at, minlength=k)
            y = roomy(y, largest(y) * max(len(y), 1))
            for c in np.unique(at).tolist():
                sums[c] += y[at == c].sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(counts), *(decimals(sums[:, i]) for i in range(dims))], ["c", "n", *names]
        )

    schema = ", ".join(["c int, n bigint", *(f"{s} decimal(38,0)" for s in names)])
    parts = vectors.mapInArrow(summed, schema).where("n > 0")
    rows = parts.groupBy("c").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in names)).collect()
    return {r["c"]: (r["n"], [int(r[s]) for s in names]) for r in rows}


def cluster(vectors: DataFrame, clusters: Clusters = Clusters(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid): every kept vector with its nearest centroid after the rounds."""
    dims = clusters.dims
    kept = vectors.where((F.size(vector) == dims) & finite(F.col(vector)))
    whole = kept.select(F.col(key).alias("key"), floored(F.col(vector), clusters.scale).alias("x"))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = transformed(matrix(batch.column(1), dims))
            lists = pa.ListArray.from_arrays(np.arange(0, y.size + 1, dims, dtype=np.int32), pa.array(y.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["key", "y"])

    kind = whole.schema["key"].dataType.simpleString()
    held = written(whole.mapInArrow(transform, f"key {kind}, y array<bigint>"), "coefficients")
    drawn = F.sha2(F.concat(F.lit(f"{clusters.seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    first = held.select(drawn.alias("h"), "y").orderBy("h", "y").limit(clusters.count).collect()
    h = walsh(dims).astype(object)
    back = lambda y: h.T @ np.array(y, object) // dims  # noqa: E731  exact: the matrix times itself turned is dims times the identity
    centroids = [back(r["y"]) for r in first]
    forward = lambda: [[int(v) for v in h @ c] for c in centroids]
    out = f"key {kind}, cluster int, distance bigint"
    if centroids:
        for _ in range(clusters.rounds):
            for c, (n, sums) in _round(held, forward(), dims).items():
                centroids[c] = back(sums) // n
    coefficients = forward()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, at, distance in _assigned(batches, coefficients, dims) if coefficients else ():
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(at, pa.int32()), pa.array(distance, pa.int64())], ["key", "cluster", "distance"])

    found = written(held.mapInArrow(assign, out), "assigned")
    by = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    number = lambda v: F.lit(str(v)).cast("decimal(38,0)").cast("bigint")
    texts = [",".join(str(v) for v in c) for c in centroids] or [""]
    return found.select(
        F.col("key").alias(key),
        "cluster",
        "distance",
        of([number(by.get(c, 0)) for c in range(len(texts))]).alias("cluster_inertia"),
        number(sum(by.values())).alias("inertia"),
        of([F.lit(t) for t in texts]).alias("centroid"),
    )


def cluster_sql(clusters: Clusters = Clusters()) -> str:
    """The digest of ``op12`` in SQL: every distance in full, a common table expression a round."""
    dims = clusters.dims
    parts = [
        f"""v as materialized (select row_number() over () as r, vec_id,
          list_transform(embedding, lambda e: floor({clusters.scale} * e::double)::bigint) as x from embeddings
          where len(embedding) = {dims} and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = {dims})""",
        f"""c0 as materialized (select row_number() over (order by h, x) - 1 as k, x as c from
          (select sha256('{clusters.seed}:' || coalesce(vec_id::varchar, '')) as h, x from v order by h, x limit {clusters.count}))""",
    ]
    for i in range(clusters.rounds + 1):
        parts.append(
            f"""a{i} as materialized (select r, any_value(vec_id) as vec_id, any_value(x) as x, min((d, k)) as best from
              (select r, vec_id, x, k, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
              from v cross join c{i}) group by r)"""
        )
        if i < clusters.rounds:
            parts.append(
                f"""c{i + 1} as materialized (select c{i}.k, coalesce(m.c, c{i}.c) as c from c{i} left join
                  (select k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from
                    (select k, i, sum(e)::hugeint as s, count(*) as n from
                      (select best[2] as k, unnest(x) as e, unnest(range({dims})) as i from a{i}) group by k, i) group by k) m on m.k = c{i}.k)"""
            )
    last = clusters.rounds
    return f"""with {", ".join(parts)}
select vec_id, a.best[2]::int as cluster, a.best[1] as distance,
  (sum(a.best[1]) over (partition by a.best[2]))::bigint as cluster_inertia, (sum(a.best[1]) over ())::bigint as inertia,
  sha256(array_to_string(c.c, ',')) as centroid_sha256
from a{last} a join c{last} c on c.k = a.best[2]"""

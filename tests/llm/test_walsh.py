import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import queries
from millrace.llm.walsh import Clusters, cluster, nearest, transformed, walsh

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def brute(rows, clusters):
    """Rows of (id, cluster, distance, cluster inertia, inertia, centroid) with plain loops over whole numbers."""
    kept = []
    for key, v in rows:
        if v is not None and len(v) == clusters.dims and all(e is not None and math.isfinite(e) for e in v):
            kept.append((key, [math.floor(clusters.scale * e) for e in v]))
    draw = lambda key: hashlib.sha256(f"{clusters.seed}:{'' if key is None else key}".encode()).hexdigest()
    centres = [x for _, x in sorted(kept, key=lambda r: (draw(r[0]), r[1]))[: clusters.count]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    best = lambda x: min((far(x, c), i) for i, c in enumerate(centres))
    for _ in range(clusters.rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(best(x)[1], []).append(x)
        for i, xs in groups.items():
            centres[i] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [(key, *best(x)[::-1]) for key, x in kept]
    total = lambda at: sum(d for _, c, d in found if at is None or c == at)
    return sorted((key, c, d, total(c), total(None), ",".join(map(str, centres[c]))) for key, c, d in found)


def run(spark, rows, clusters, extra=()):
    frame = spark.createDataFrame(rows, ROWS).repartition(3).withColumns({c: F.lit("x") for c in extra})
    return sorted(tuple(r) for r in cluster(frame, clusters).collect())


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (20, 64))
    h = walsh(64)
    assert np.array_equal(h @ h.T, 64 * np.eye(64, dtype=int)) and (np.diff(h[5]) != 0).sum() == 5
    assert np.array_equal(transformed(x), x @ h.T)
    at, distance = nearest(transformed(x), transformed(x[:7]))
    full = ((x[:, None] - x[None, :7]) ** 2).sum(axis=2)
    assert np.array_equal(distance, full.min(axis=1)) and np.array_equal(at, full.argmin(axis=1))


def test_ties_go_to_the_smaller_number_and_large_numbers_stay_exact():
    centres = np.array([[9, 0], [0, 1], [1, 0], [0, 1]])
    at, distance = nearest(transformed(np.zeros((3, 2), int)), transformed(centres))
    assert at.tolist() == [1, 1, 1] and distance.tolist() == [1, 1, 1]
    big = np.array([[1 << 40, 3], [0, 0]])
    at, distance = nearest(transformed(big), transformed(np.array([[(1 << 40) - 5, 3], [1, 1]])))
    assert at.tolist() == [0, 1] and list(distance) == [25, 2]


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    small = Clusters(count=3, rounds=4, scale=16, dims=8)
    rows = [(int(i), rng.normal(size=8).round(2).tolist()) for i in range(60)]
    rows += [(7, rows[9][1]), (8, rows[9][1]), (8, rows[9][1]), (61, [0.0] * 8), (62, [-0.0] * 8), (63, [900.0] * 8)]
    rows += [(64, None), (65, []), (66, [1.0] * 7), (67, [float("nan")] * 8), (68, [1.0] * 7 + [None]), (69, [float("inf")] + [0.0] * 7)]
    rows += [(-1, [-1e-9] * 8)]
    assert run(spark, rows, small, extra=("cluster", "distance", "key", "y", "x", "n", "inertia")) == brute(rows, small)
    kept = cluster(spark.createDataFrame([(None, [0.5] * 8)], ROWS), small).collect()
    assert [r.vec_id for r in kept] == [None] and kept[0].distance == 0


def test_fewer_vectors_than_centroids_and_none(spark):
    small = Clusters(count=5, rounds=3, scale=16, dims=4)
    rows = [(1, [0.0] * 4), (2, [5.0] * 4), (3, [5.0] * 4)]
    assert run(spark, rows, small) == brute(rows, small)
    assert run(spark, [], small) == run(spark, [(1, None)], small) == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30] * 4)], Clusters(dims=4))


def test_query_equals_brute_force_and_sql(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = sorted(tuple(r) for r in queries.op12_walsh_clusters(spark, small).collect())
    assert found == [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest()) for r in brute(rows, queries.CLUSTERS)]
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{small}/embeddings.parquet')")
    assert sorted(con.execute(queries.ORACLES["op12_walsh_clusters"]).fetchall()) == found

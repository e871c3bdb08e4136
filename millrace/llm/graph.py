"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) and the least node that it reaches.

    Each round links a node's larger neighbours, then its smaller ones, to the least
    one, and writes the edges; the number of rounds grows with the logarithm of the
    longest path. A node with many neighbours is aggregated before it is shuffled and
    joined by a join that adaptive execution can split. No edge reaches the driver.
    """
    swapped = edges.where("a != b")
    now = written(swapped.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        linked = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            break
        mark = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

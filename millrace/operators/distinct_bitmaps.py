"""Exact distinct counts that merge: bitmaps of dense ids, stored in plain folders.

An id's place is a bit of a chunk of 32,768 ids; a group has a row for each chunk it has ids in. Bitmaps of several
batches are put together bit by bit, so repeated batches change nothing, and a batch rewrites the folders
of its chunks only. Ids should be dense (``keys.assign_keys``): the rows are as few as the ids are close.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import folders
from millrace.session import staged

PARTS = 16


def bitmaps(df: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """(group, chunk, bits) of the ids (1 or more) in each group; missing ids are left out."""
    chunk = F.bitmap_bucket_number(key).alias("chunk")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")
    return df.where(F.col(key).isNotNull()).groupBy(*group, chunk).agg(bits)


def merged(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """One bitmap for each group and chunk."""
    return parts.groupBy(*group, "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(parts: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """How many distinct ids each group has; ``parts`` may hold several bitmaps of a chunk."""
    return merged(parts, group).groupBy(*group).agg(F.sum(F.bitmap_count("bits")).alias(name))


def add_bitmaps(batch: DataFrame, path: str, group: Sequence[str]) -> None:
    """Put a batch's bitmaps into the stored ones: only the folders of its chunks are read and replaced."""
    spark, part = batch.sparkSession, F.pmod("chunk", F.lit(PARTS)).cast("int").alias("part")
    columns = [*group, "chunk", "bits"]
    with staged(merged(batch, group).select(*columns, part), "bitmaps") as new:
        touched = sorted(r[0] for r in new.select("part").distinct().collect())
        both = new.select(*columns)
        if folders.names(spark, path):
            both = both.unionByName(spark.read.parquet(path).where(F.col("part").isin(touched)).select(*columns))
        rows = merged(both, group).select(*columns, part).hint("rebalance", "part")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def stored_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("part")

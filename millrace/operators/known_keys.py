"""Key checks on arrival: a batch is checked against the keys seen before without counting the whole table.

Known keys lie in plain folders by a hash of the key, beside a filter: one bit for each hash in ``1 << bits``, stored as
bitmaps in folders of the same buckets. A key whose bit isn't set was never seen, which clears most rows; the others are
compared with the keys of their own buckets. Keys are appended, so a batch writes to its buckets only.
A key of one text, number or date column; missing keys are neither known nor checked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import folders

@dataclass(frozen=True)
class KnownKeys:
    """``bits`` for the table's final size: about eight times as many places as keys, 30 for a hundred million."""

    path: str
    buckets: int = 32
    bits: int = 30

    def _place(self, key: Column) -> tuple[Column, Column, Column]:
        """Bucket, chunk and bit of a key."""
        at = F.shiftrightunsigned(F.xxhash64(key), 64 - self.bits) + 1
        return F.pmod(F.bitmap_bucket_number(at), F.lit(self.buckets)).cast("int"), F.bitmap_bucket_number(at), F.bitmap_bit_position(at)

    def _placed(self, batch: DataFrame, key: str) -> DataFrame:
        bucket, chunk, bit = self._place(F.col(key))
        return batch.where(F.col(key).isNotNull()).withColumns({"_bucket": bucket, "_chunk": chunk, "_bit": bit})

    def add(self, batch: DataFrame, key: str) -> None:
        """Append the batch's keys and their bits."""
        keys = self._placed(batch.select(F.col(key).alias("key")).distinct(), "key")
        bits = keys.groupBy("_bucket", "_chunk").agg(F.bitmap_construct_agg("_bit").alias("bits"))
        keys.select("key", "_bucket").hint("rebalance", "_bucket").write.mode("append").partitionBy("_bucket").parquet(f"{self.path}/keys")
        bits.hint("rebalance", "_bucket").write.mode("append").partitionBy("_bucket").parquet(f"{self.path}/filter")

    def _marked(self, batch: DataFrame, key: str) -> DataFrame:
        """Rows with a key, with ``_known``: whether it was added before."""
        spark = batch.sparkSession
        placed = self._placed(batch, key)
        if not folders.names(spark, f"{self.path}/keys"):
            return placed.withColumn("_known", F.lit(False)).drop("_bucket", "_chunk", "_bit")
        touched = sorted(r[0] for r in placed.select("_bucket").distinct().collect())
        stored = spark.read.parquet(f"{self.path}/filter").where(F.col("_bucket").isin(touched))
        merged = stored.groupBy("_chunk").agg(F.bitmap_or_agg("bits").alias("_bits"))
        # A bitmap of one chunk is 4,096 bytes: the batch's rows look up their bit by byte and place.
        byte = F.conv(F.hex(F.substring("_bits", F.expr("int(_bit div 8) + 1"), F.lit(1))), 16, 10).cast("int")
        bit_set = F.coalesce(F.expr("shiftright(_byte, int(_bit % 8))").bitwiseAND(1) == 1, F.lit(False))
        seen = placed.join(merged, "_chunk", "left").withColumn("_byte", byte).withColumn("_maybe", bit_set).drop("_bits", "_byte")
        keys = spark.read.parquet(f"{self.path}/keys").where(F.col("_bucket").isin(touched)).select(F.col("key").alias("_key")).distinct()
        sure = seen.where(~F.col("_maybe")).withColumn("_known", F.lit(False))
        asked = seen.where("_maybe").join(keys, F.col(key) == F.col("_key"), "left").withColumn("_known", F.col("_key").isNotNull())
        return sure.unionByName(asked.drop("_key")).drop("_bucket", "_chunk", "_bit", "_maybe")

    def repeated(self, batch: DataFrame, key: str) -> DataFrame:
        """(key, rows): keys of the batch that were added before or stand in it several times, with their rows in the batch."""
        counts = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        return self._marked(counts, key).where(F.col("_known") | (F.col("rows") > 1)).select(key, "rows")

    def missing(self, batch: DataFrame, key: str) -> DataFrame:
        """Rows of the batch whose (foreign) key was never added."""
        return self._marked(batch, key).where(~F.col("_known")).drop("_known")

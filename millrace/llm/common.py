"""Helpers shared by the operators: tables, text tables, bucketed positions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

HASH_BITS = 60
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def beside(rows: DataFrame) -> DataFrame:
    """Mark a written table of short rows for a broadcast if it has at most ``BROADCAST_ROWS``.

    A larger one is joined by shuffles, which adaptive execution splits where a key is hot.
    """
    few = rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(rows) if few else rows


def seeded_order(seed: Column | int, key: Column) -> Column:
    """A number below 2**60 drawn from seed and key; md5, so that SQL engines can repeat it."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    text = F.concat_ws(":", seed.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def positions(
    df: DataFrame,
    group: Sequence[str],
    score: str,
    order: Sequence[str],
    size: str,
    name: str,
    per_bucket: int = 2000,
) -> DataFrame:
    """Number the rows of each group from 0 along ``score`` and then ``order``.

    ``score`` is a double in [0, 1) and ``size`` holds the group's row count. A
    group is cut by score into buckets whose number grows with the group, so no
    task sorts a whole group: it needs the counts of the buckets before and a
    row number inside its own. Groups must not be null.
    """
    buckets = F.ceil(F.col(size) / F.greatest(F.lit(float(per_bucket)), F.sqrt(F.col(size))))
    bucket = F.least(F.floor(F.col(score) * buckets), buckets - 1).cast("bigint")
    # Dealt by group and bucket: a partitioning by group alone would put a hot group into one task.
    cut = df.withColumn("_bucket", bucket).repartition(*group, "_bucket")
    counts = cut.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(score, *order)
    return (
        cut.withColumn("_row", F.row_number().over(inside))
        .join(starts, [*group, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_bucket", "_row", "_start")
    )


def byte_table(word_byte, lower: bool = True, gap: int = 0x20) -> bytes:
    """Translation of UTF-8 bytes: A-Z to lower case, bytes outside words to ``gap``."""
    out = bytearray(range(256))
    for b in range(256):
        low = b + 32 if lower and 0x41 <= b <= 0x5A else b
        out[b] = low if word_byte(low) else gap
    return bytes(out)


# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text: digits, a-z, and all beyond ASCII.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
# Words [^\x20\x09-\x0D]+ of lower-cased text: all but ASCII blanks.
UNSPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


def words_of(text: str | None, by: bytes = ALNUM) -> list[bytes]:
    """Normalised words of a text; none for a missing one."""
    return (text or "").encode("utf-8", "surrogatepass").translate(by).split()


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h

"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.session import scratch_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below
_HASHES = 1 << 18


def assign_keys(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Give the rows dense growing ids along the order columns.

    The rows are range-sorted and written once with their partition and row
    number. Both the partition offsets and the ids are taken from that written
    table, so they agree even if a task is repeated. The offsets are one row per
    range partition. Let the order columns be unique together: the ids are then
    repeatable, and a frequent first column is split by the others.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "keys")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    marked = spark.read.parquet(path).withColumn("_part", F.shiftright("_mark", _LOCAL_BITS))
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: bounded by the shuffle partition setting.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_mark").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        marked.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + local + F.lit(start)).cast("bigint"))
        .select(name, *df.columns)
    )


def number_within(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 1 along the order columns; missing group values are a group."""
    return reduce(DataFrame.unionAll, numbered_parts(df, group, order, name))


def numbered_parts(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, by: Sequence[str] = (), most: int = 100_000
) -> list[DataFrame]:
    """The numbered rows as one or two frames: all but those of large groups, and these, if there are any.

    Rows are dealt once by hash of the group, or of ``by``, some of its columns, where a join on these follows. Groups are counted by
    hash first. Those of a hash with more than ``most`` rows are sorted by ranges of group and order, so a group that holds
    most rows is dealt over many tasks.
    """
    hashed = F.pmod(F.xxhash64(*group), F.lit(_HASHES))
    counts = df.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    large = [r["_hash"] for r in counts.select("_hash").collect()]  # bounded by the number of hashes
    inside = Window.partitionBy(*group).orderBy(*(order or group))
    small = df.where(~hashed.isin(large)) if large else df
    parts = [small.repartition(*(by or group)).withColumn(name, F.row_number().over(inside).cast("bigint"))]
    if large:
        same = lambda a, b: reduce(and_, (a[c].eqNullSafe(b[f"_{c}"]) for c in group))
        repeated = df.where(hashed.isin(large)).withColumn("_tie", F.monotonically_increasing_id())
        placed = assign_keys(repeated, [*group, *order, "_tie"], "_place")
        firsts = placed.groupBy(*group).agg(F.min("_place").alias("_first")).withColumnsRenamed({c: f"_{c}" for c in group})
        ranked = placed.join(firsts, same(placed, firsts)).withColumn(name, F.col("_place") - F.col("_first") + 1)
        parts.append(ranked.select(*parts[0].columns))
    return parts


def next_key(df: DataFrame, key: str) -> int:
    """The id that follows the largest one in use."""
    return (df.agg(F.max(key)).first()[0] or 0) + 1

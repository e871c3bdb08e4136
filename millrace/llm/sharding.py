"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded order and ranked; a row's fractional
rank is (rank + start) / rows of its source, where start is a seeded number in [0, 1) for
each source, so that sources of like size do not take turns in lockstep. Sorted by
fractional rank, every stretch of rows holds the sources in their overall
proportions, so the sorted rows are cut into shards of equal row counts.

Only identifiers, sizes and checksums are shuffled. Ranks and positions come
from bucket counts (``common.positions``), so one source may hold most rows.

Defined cases: a null source is a stratum of its own; a null text has size 16 and
checksum 0; the seeded order is drawn from identifier and checksum, so rows with equal or missing
identifiers are spread by their texts; rows of equal identifier and text are neighbours and interchangeable; an empty table
gives an empty result. Equal texts have no part in the law ``rows``: copies go to shards as any rows do, since keeping them
together would make the counts of shards differ. Input columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.common import beside, positions
from millrace.session import written

OVERHEAD = 16  # bytes a row takes besides its text


def assign_shards(
    docs: DataFrame, shards: int = 40, seed: int = 17, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row; row counts of shards differ by one at most."""
    plain = F.coalesce(F.col(text), F.lit(""))
    crc = F.crc32(plain.cast("binary"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key), crc), 11) / F.lit(float(1 << 53))
    facts = written(
        docs.select(
            F.col(key),
            (F.octet_length(plain) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
            crc.alias("text_crc32"),
            F.struct(F.col(source)).alias("_stratum"),
            draw.alias("_draw"),
        ),
        "shard-facts",
    )
    strata = written(facts.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_rows")), "shard-strata")
    total = strata.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    ties = [key, "text_crc32", "size"]
    ranked = positions(facts.join(beside(strata), "_stratum"), ["_stratum"], "_draw", ties, "_rows", "_rank")
    start = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_stratum"), 11) / F.lit(float(1 << 53))
    share = ranked.withColumn("_share", (F.col("_rank") + start) / F.col("_rows")).withColumns(
        {"_all": F.lit(0), "_total": F.lit(total).cast("bigint")}
    )
    placed = positions(share, ["_all"], "_share", ["_stratum", "_draw", *ties], "_total", "_at")
    shard = F.expr(f"(_at * {shards}) div _total")
    return placed.withColumn("shard", shard.cast("int")).select(
        key,
        "size",
        "text_crc32",
        "shard",
        # The first position of a shard is the ceiling of shard * total / shards.
        (F.col("_at") - F.expr(f"(shard * _total + {shards - 1}) div {shards}")).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 17, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` with their shard and slot."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    same = ["key", "crc", "copy"]
    copy = F.row_number().over(Window.partitionBy("key", "crc").orderBy(F.lit(0)))
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    # The columns go as one struct, so that no name can clash.
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(key).alias("key"), crc.alias("crc")).withColumn("copy", copy)
    right = (
        assign_shards(docs, shards, seed, key, text, source)
        .select(F.col(key).alias("key"), F.col("text_crc32").alias("crc"), "shard", "slot")
        .withColumn("copy", copy)
    )
    on = [left[c].eqNullSafe(right[c]) for c in same]
    return left.join(right, on).select("row.*", "shard", "slot")

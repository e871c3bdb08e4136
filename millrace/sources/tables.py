"""Tables that are refreshed as a whole or upserted by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import folders
from millrace.session import staged

_BUCKET = "_bucket"


def full_refresh(
    spark: SparkSession, tables: Mapping[str, tuple[DataFrame, T.StructType]], location: str
) -> None:
    """Drop and reload tables with declared columns, named parent first.

    Children are dropped before their parents. Repeating the call gives the
    same tables. Missing mandatory columns stop the load.
    """
    for name in reversed(list(tables)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for name, (df, schema) in tables.items():
        typed = [_declared(f).alias(f.name) for f in schema.fields]
        df.select(*typed).write.mode("overwrite").option("path", f"{location}/{name}").saveAsTable(name)


def _declared(field: T.StructField) -> Column:
    value = F.col(field.name).cast(field.dataType)
    if field.nullable:
        return value
    message = F.lit(f"{field.name} is missing")
    return F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)


def refresh_stored_view(view: DataFrame, path: str) -> DataFrame:
    """Compute a stored view anew and return the stored rows."""
    view.write.mode("overwrite").parquet(path)
    return view.sparkSession.read.schema(view.schema).parquet(path)


def last_per_key(batch: DataFrame, key: str, sequence: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """The last record of each key; ``sequence`` must be unique within a key.

    ``columns`` names the record's fields where the batch carries more.
    Records without a key are left out: they match nothing.
    """
    record = F.struct(*(columns or batch.columns))
    last = batch.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max_by(record, sequence).alias("_last"))
    return last.select("_last.*")


def merge_by_key(
    stored: DataFrame, batch: DataFrame, key: str, stamp: str | None = None, now: Column | None = None
) -> DataFrame:
    """Stored rows with the batch (one row per key) set over them.

    A field of the batch replaces the stored one, also by NULL. Stored fields
    the batch does not have stay, and new keys are added. With ``stamp``, that
    column becomes ``now`` on new rows and on rows where any field differs.

    Stored rows are joined to the batch, and the batch's unknown keys are added.
    The optimizer picks the joins by the sizes it knows.
    """
    fields = _merged_fields(stored, batch, key, stamp, now)
    old, new = stored.alias("old"), batch.alias("new")
    updated = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "left").select(*fields)
    inserted = batch.join(stored.select(key), key, "left_anti").alias("new")
    # No stored row has these keys, so the stored side is all NULL.
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema.fields]
    padded = inserted.select(F.struct("new.*").alias("new"), F.struct(*nothing).alias("old"))
    return updated.unionAll(padded.select(*fields))


def _merged_fields(
    stored: DataFrame, batch: DataFrame, key: str, stamp: str | None, now: Column | None
) -> list[Column]:
    """Columns of a merged row, given its ``old`` and ``new`` side."""
    in_batch = F.col(f"new.{key}").isNotNull()
    differs = F.col(f"old.{key}").isNull()
    names = [c for c in stored.columns if c != stamp]
    names += [c for c in batch.columns if c not in names and c != stamp]
    merged = []
    for name in names:
        if name not in batch.columns:
            value = F.col(f"old.{name}")
        elif name not in stored.columns:
            value = F.col(f"new.{name}")
            differs = differs | value.isNotNull()
        else:
            value = F.when(in_batch, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
            differs = differs | ~F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}"))
        merged.append(value.alias(name))
    if stamp:
        kept = F.col(f"old.{stamp}") if stamp in stored.columns else F.lit(None).cast("timestamp_ntz")
        merged.append(F.when(in_batch & differs, now).otherwise(kept).alias(stamp))
    return merged


def merge_statement(table: str, batch_view: str, key: str, columns: Sequence[str]) -> str:
    """The same upsert as MERGE text for a catalog with row-level writes."""
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {table} t USING {batch_view} s ON t.`{key}` = s.`{key}` "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def _log(path: str) -> str:
    return f"{path.rstrip('/')}_batches"


def applied_batches(spark: SparkSession, path: str) -> DataFrame:
    """(writer, number, buckets): the batches a keyed table holds; ``writer`` is NULL for unnumbered ones."""
    schema = "writer string, number bigint, buckets int"
    if not folders.names(spark, _log(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_log(path))


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a keyed table, None while there is none. Buckets written before a column came lack it."""
    if not any(n.startswith(_BUCKET) for n in folders.names(spark, path)):
        return None
    return spark.read.option("mergeSchema", "true").parquet(path).drop(_BUCKET)


def upsert_by_key(
    batch: DataFrame,
    path: str,
    key: str,
    sequence: Column,
    columns: Sequence[str] | None = None,
    buckets: int = 16,
    writer: str | None = None,
    number: int = 0,
    stamp: str | None = None,
    now: Column | None = None,
) -> bool:
    """Set the last record per key of a batch over a plain Parquet table partitioned by a hash of the key.

    Only the partitions that the batch touches are read, merged and replaced (dynamic partition overwrite). Choose
    ``buckets`` for the table's final size; another number later is an error. A writer that may repeat itself names itself and
    numbers its batches: a number up to its last one in the log of batches has no effect, and False is returned.
    The log is written last. A batch that failed between its partitions is repeated, and as
    setting the same records twice changes nothing, the table ends the same.

    One batch at a time: where several writers meet, use a catalog with row-level writes and ``merge_statement``.
    """
    spark = batch.sparkSession
    past = applied_batches(spark, path).groupBy("writer").agg(F.max("number").alias("number"), F.max("buckets").alias("buckets")).collect()
    for known in past:
        if known["buckets"] != buckets:
            raise ValueError(f"{path} has {known['buckets']} buckets, not {buckets}")
        if writer is not None and known["writer"] == writer and number <= known["number"]:
            return False
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(_BUCKET)
    # Written first: the batch is read three times from here on.
    with staged(last_per_key(batch, key, sequence, columns).select("*", bucket), "batch") as latest:
        touched = sorted(r[0] for r in latest.select(_BUCKET).distinct().collect())
        new = latest.drop(_BUCKET)
        if touched and read_keyed(spark, path) is not None:
            held = spark.read.option("mergeSchema", "true").parquet(path).where(F.col(_BUCKET).isin(touched))
            merged = merge_by_key(held.drop(_BUCKET), new, key, stamp, now)
        else:
            merged = new.withColumn(stamp, now) if stamp else new
        if touched:
            dealt = merged.select("*", bucket).hint("rebalance", _BUCKET)
            dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
    entry = spark.createDataFrame([(writer, number, buckets)], "writer string, number bigint, buckets int")
    entry.coalesce(1).write.mode("append").parquet(_log(path))
    return True

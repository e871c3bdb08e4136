"""Ordered-sequence operators over many series.

A series may be long, so no task sorts a whole one. Positions are cut into
chunks, each chunk of a series is one window group, and only the borders of
the chunks (at most two rows per chunk) are put in order per series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

CHUNK = 1_000_000


def _chunked(df: DataFrame, series: str, pos: str, value: str, chunk: int) -> DataFrame:
    return df.select(series, pos, value, F.expr(f"`{pos}` div {chunk}").alias("_chunk"))


def max_after(df: DataFrame, series: str, pos: str, value: str, marker: float = 0, chunk: int = CHUNK) -> DataFrame:
    """Per series the largest value directly after a marker value, NULL if none.

    ``pos`` is a whole number, unique within its series.
    """
    inside = Window.partitionBy(series, "_chunk").orderBy(pos)
    rows = _chunked(df, series, pos, value, chunk).withColumn("_prev", F.lag(value).over(inside))
    chunks = rows.groupBy(series, "_chunk").agg(
        F.max(F.when(F.col("_prev") == marker, F.col(value))).alias("_inner"),
        F.min_by(value, pos).alias("_first"),
        F.max_by(value, pos).alias("_last"),
    )
    across = Window.partitionBy(series).orderBy("_chunk")
    chunks = chunks.withColumn("_before", F.lag("_last").over(across))
    border = F.when(F.col("_before") == marker, F.col("_first"))
    return chunks.groupBy(series).agg(
        F.max(F.greatest(F.col("_inner"), border)).alias("max_after")
    )


def run_lengths(df: DataFrame, series: str, pos: str, value: str, chunk: int = CHUNK) -> DataFrame:
    """Runs of equal neighbours: series, first position, value, length.

    ``pos`` is a whole number, unique within its series. Runs inside a chunk
    are final; first and last runs are joined with their neighbours.
    """
    inside = Window.partitionBy(series, "_chunk").orderBy(pos)
    rows = _chunked(df, series, pos, value, chunk)
    begins = F.row_number().over(inside) == 1
    changed = begins | ~F.col(value).eqNullSafe(F.lag(value).over(inside))
    rows = rows.withColumn("_new", changed.cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy(series, "_chunk", "_run").agg(
        F.min(pos).alias("start_pos"),
        F.first(value).alias(value),
        F.count(F.lit(1)).alias("run_length"),
    )
    last_run = F.max("_run").over(Window.partitionBy(series, "_chunk"))
    runs = runs.withColumn("_edge", (F.col("_run") == 1) | (F.col("_run") == last_run))

    across = Window.partitionBy(series).orderBy("_chunk", "_run")
    edges = runs.where("_edge")
    # A later run of a chunk differs from the run before it, which may lie inside.
    joins = (F.col("_run") == 1) & F.col(value).eqNullSafe(F.lag(value).over(across)) & (
        F.row_number().over(across) > 1
    )
    edges = edges.withColumn("_new", (~joins).cast("int"))
    edges = edges.withColumn("_whole", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    merged = edges.groupBy(series, "_whole").agg(
        F.min("start_pos").alias("start_pos"),
        F.first(value).alias(value),
        F.sum("run_length").alias("run_length"),
    )
    cols = [series, "start_pos", value, "run_length"]
    return runs.where(~F.col("_edge")).select(*cols).unionAll(merged.select(*cols))

"""File-arrival job: pick up review files, clean them, upsert them by key.

One streaming query replaces a polling schedule. The file source takes each
file once (checkpoint), ``foreachBatch`` skips empty arrivals, cleans, and
upserts under the query's id and the batch number, so a repeated batch changes
nothing, and a query with a new checkpoint starts a numbering of its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import folders
from millrace.functions.dates import coerce_ts
from millrace.functions.text import DEFAULT_MISSING, REVIEW_MISSING, clean_text, missing_to_null, trim_blanks
from millrace.operators.rows import clean_missing_cells, null_missing_cells, sort_by_ts_nulls_last
from millrace.sources.pieces import csv_records, text_pieces
from millrace.sources.readers import parsed_csv
from millrace.sources.tables import upsert_by_key

_CORRUPT = "_corrupt_record"


def _default_columns() -> dict[str, str]:
    return {"review_id": "string", "content": "string", "score": "double", "at": "string"}


@dataclass(frozen=True)
class ReviewLayout:
    """Columns of the files in header order with their types, and the key.

    ``content`` and ``at`` get their own cleaning where they are present;
    all other columns pass through.
    """

    key: str = "review_id"
    columns: dict[str, str] = field(default_factory=_default_columns)


LAYOUT = ReviewLayout()


@dataclass(frozen=True)
class ReviewPaths:
    """Folders of one job, all below a file system the executors share."""

    inbox: str
    table: str
    checkpoint: str
    log: str
    rejects: str
    archive: str | None = None


def arrivals(
    spark: SparkSession, paths: ReviewPaths, layout: ReviewLayout = LAYOUT, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files' lines with their place of arrival; ``review_rows`` makes rows of a batch of them."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if paths.archive:
        # The source moves a finished file when a later batch is planned.
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", paths.archive)
    return text_pieces(reader, paths.inbox, "\n")


def review_rows(lines: DataFrame, layout: ReviewLayout = LAYOUT) -> DataFrame:
    """Raw review rows (all text) of the files' lines, with their place of arrival; a large file is read by many tasks."""
    rows = parsed_csv(csv_records(lines), list(layout.columns), _CORRUPT)
    return rows.withColumnRenamed("_at", "_line")


def unreadable(layout: ReviewLayout = LAYOUT) -> Column:
    """Rows the table cannot take: broken CSV, or no usable key once cleaned."""
    given = trim_blanks(missing_to_null(F.col(layout.key), REVIEW_MISSING))
    key = missing_to_null(given, DEFAULT_MISSING).try_cast(layout.columns[layout.key])
    return F.col(_CORRUPT).isNotNull() | key.isNull()


def clean_reviews(raw: DataFrame, layout: ReviewLayout = LAYOUT) -> DataFrame:
    """Mark missing cells, parse the date, clean the content, type the columns.

    Between the steps, text is matched against the missing-value texts again:
    the steps hand over files, so a cell that became one of these texts is
    missing for the step after it.
    """
    texts = list(layout.columns)
    out = null_missing_cells(clean_missing_cells(raw, texts), DEFAULT_MISSING, texts)
    if "at" in texts:
        out = out.withColumn("at", coerce_ts(F.col("at")))
    if "content" in texts:
        out = out.withColumn("content", clean_text(F.col("content")))
        out = null_missing_cells(out, DEFAULT_MISSING, ["content"])
    typed = {c: F.col(c).try_cast(t) for c, t in layout.columns.items() if t != "string" and c != "at"}
    return out.withColumns(typed)


def last_wins(layout: ReviewLayout = LAYOUT) -> Column:
    """Order in which records of a batch apply: by file, then date, then line."""
    dated = [F.col("at").isNull().alias("_undated"), F.col("at")] if "at" in layout.columns else []
    return F.struct("_file_time", "_file", *dated, "_block", "_line")


def query_id(spark: SparkSession, paths: ReviewPaths) -> str:
    """Id of the query that owns the checkpoint."""
    metadata = folders.read_text(spark, f"{paths.checkpoint}/metadata")
    return json.loads(metadata)["id"] if metadata else "none"


def batch_step(
    spark: SparkSession, paths: ReviewPaths, layout: ReviewLayout = LAYOUT
) -> Callable[[DataFrame, int], None]:
    """The work on the rows of one micro-batch."""
    def place(folder: str, query: str, batch_id: int) -> str:
        return f"{folder}/query={query}/batch={batch_id}"

    def log(query: str, batch_id: int, outcome: str) -> None:
        entry = spark.range(1).select(
            F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(outcome).alias("outcome")
        )
        entry.coalesce(1).write.mode("overwrite").json(place(paths.log, query, batch_id))

    def step(raw: DataFrame, batch_id: int) -> None:
        query = query_id(spark, paths)
        # Rows of a file block stay in file order, so the number grows along the block.
        numbered = raw if "_line" in raw.columns else raw.withColumn("_line", F.monotonically_increasing_id())
        # Several outputs follow: keep the parsed rows, on disk where memory is short.
        lines = numbered.persist()
        try:
            if lines.isEmpty():
                log(query, batch_id, "empty")
                return
            bad = unreadable(layout)
            lines.where(bad).write.mode("overwrite").parquet(place(paths.rejects, query, batch_id))
            good = clean_reviews(lines.where(~bad), layout)
            upsert_by_key(good, paths.table, layout.key, last_wins(layout), list(layout.columns), writer=query, number=batch_id)
        finally:
            lines.unpersist()
        log(query, batch_id, "loaded")

    return step


def start(
    spark: SparkSession,
    paths: ReviewPaths,
    layout: ReviewLayout = LAYOUT,
    files_per_batch: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start the job: once over all waiting files, or every interval."""
    step = batch_step(spark, paths, layout)
    lines = arrivals(spark, paths, layout, files_per_batch)
    writer = lines.writeStream.foreachBatch(lambda batch, number: step(review_rows(batch, layout), number))
    writer = writer.option("checkpointLocation", paths.checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_once(
    spark: SparkSession, paths: ReviewPaths, layout: ReviewLayout = LAYOUT, files_per_batch: int | None = None
) -> None:
    """Process what has arrived and return when it is done; an error is raised."""
    query = start(spark, paths, layout, files_per_batch)
    query.awaitTermination()


def outcomes(spark: SparkSession, paths: ReviewPaths) -> DataFrame:
    return spark.read.schema("batch_id bigint, outcome string").json(f"{paths.log}/*/*")


def ordered_export(reviews: DataFrame, layout: ReviewLayout = LAYOUT) -> DataFrame:
    """Reviews in date order with undated ones last, as the file sink writes them."""
    return sort_by_ts_nulls_last(reviews, "at", layout.key)

"""Review table: cleaning steps, keyed upsert, aggregates, and the file-arrival job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as texts
from millrace.functions.dates import coerce_ts, day_start
from millrace.operators import aggregates as agg
from millrace.operators import rows
from millrace.plans.registry import job
from millrace.plans.roles import Roles
from millrace.session import scratch_dir, session_setting
from millrace.sources.readers import csv_options, without_nan
from millrace.sources.tables import last_per_key, merge_by_key, read_keyed, upsert_by_key
from millrace.sources.writers import write_csv
from millrace.streaming import reviews as stream

_BLANK = "' ' || chr(160) || chr(8195) || chr(10) || chr(9) || chr(13)"
# Fixed value: the characters a cleaned review may hold.
_CLEAN_SQL = r"""regexp_replace(coalesce({0}, ''), '[^A-Za-z0-9\s.,!?;:''"-]', '', 'g')"""


def _cleaned_sql(column: str) -> str:
    kept = f"trim({_CLEAN_SQL.format(column)}, chr(32) || chr(10) || chr(9) || chr(13))"
    return f"case when {kept} = '' then '-' else {kept} end"


def dirty_reviews(t: Roles) -> DataFrame:
    """All reviews with missing-value texts, blanks and padding put into some cells."""
    key = F.col("review_id")
    dirty = (
        F.when(key % 11 == 0, "NULL")
        .when(key % 11 == 1, "none")
        .when(key % 11 == 2, F.lit(" \u00a0\u2003 "))
        .when(key % 11 == 3, F.concat(F.lit("\u2003 "), F.col("content"), F.lit(" \u00a0")))
        .when(key % 11 == 4, F.lit(None).cast("string"))
        .otherwise(F.col("content"))
    )
    return t.reviews.withColumn("content", dirty)


_DIRTY_SQL = """v_dirty as (select review_id, score, at_text, case review_id % 11 when 0 then 'NULL' when 1 then 'none'
    when 2 then ' ' || chr(160) || chr(8195) || ' ' when 3 then chr(8195) || ' ' || content || ' ' || chr(160)
    when 4 then null else content end as content from v_reviews)"""


# ---------------------------------------------------------------- cleaning
@job(f"""with {_DIRTY_SQL}, n as (select review_id, score, at_text,
    case when content in ('NULL', 'none', '') then null else content end as content from v_dirty)
    select review_id, coalesce(trim(content, {_BLANK}), '-') as content, score,
    coalesce(at_text, '-') as at_text from n""")
def clean_nulls(t: Roles) -> DataFrame:
    return rows.clean_missing_cells(dirty_reviews(t)).select("review_id", "content", "score", "at_text")


@job(f"select doc_id, {_cleaned_sql('text')} as content from documents")
def clean_text(t: Roles) -> DataFrame:
    return t.table("documents").select("doc_id", texts.clean_text(F.col("text")).alias("content"))


@job("select review_id, try_strptime(at_text, '%Y-%m-%d %H:%M:%S') as \"at\" from v_reviews", name="coerce_ts")
def coerced_ts(t: Roles) -> DataFrame:
    return t.reviews.select("review_id", coerce_ts(F.col("at_text")).alias("at"))


@job("""select review_id, try_strptime(at_text, '%Y-%m-%d %H:%M:%S') as "at" from v_reviews
    order by "at" nulls last, review_id""")
def sort_by_ts_nulls_last(t: Roles) -> DataFrame:
    dated = t.reviews.select("review_id", coerce_ts(F.col("at_text")).alias("at"))
    return rows.sort_by_ts_nulls_last(dated, "at", "review_id")


@job("select doc_id, text from documents where length(text) < 5")
def filter_short_text(t: Roles) -> DataFrame:
    docs = t.table("documents")
    return docs.where(texts.shorter_than(F.col("text"), 5)).select("doc_id", "text")


@job("""select event_id, case when value > 480 then null else value end as value from events""")
def nan_to_null(t: Roles) -> DataFrame:
    """Readings above the instrument's range arrive as NaN and leave as NULL."""
    value = F.when(F.col("value") > 480, F.lit(float("nan"))).otherwise(F.col("value"))
    return without_nan(t.table("events").select("event_id", value.alias("value")))


# ---------------------------------------------------------------- aggregates
@job("select text, count(*) as n from documents group by text order by n desc, text nulls first limit 5")
def top5_frequent(t: Roles) -> DataFrame:
    return agg.most_frequent_texts(t.table("documents"), "text", 5)


@job("""with scored as (select case event_id % 17 when 0 then 'bad' when 1 then strftime(ts, '%Y-%-m-%-d %-H:%M:%S')
    else strftime(ts, '%Y-%m-%d %H:%M:%S') end as at_text,
    case when event_id % 13 = 0 then 'n/a' else cast(value as varchar) end as score from events)
    select date_trunc('day', try_strptime(at_text, '%Y-%m-%d %H:%M:%S'))::timestamp as day,
    round(avg(try_cast(score as double)), 6) as avg_score from scored group by 1""")
def avg_per_day(t: Roles) -> DataFrame:
    """Mean score per day over all events as scores in text form; undated ones are one group, others than numbers don't count."""
    key = F.col("event_id")
    at = (
        F.when(key % 17 == 0, "bad")
        .when(key % 17 == 1, F.date_format("ts", "yyyy-M-d H:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    score = F.when(key % 13 == 0, "n/a").otherwise(F.col("value").cast("string"))
    means = agg.mean_per_day(t.table("events").select(at.alias("at"), score.alias("score")), day_start(coerce_ts(F.col("at"))), F.col("score"))
    # Rounded here, as engines add doubles in different orders.
    return means.withColumn("avg_score", F.round("avg_score", 6))


# ---------------------------------------------------------------- upsert
def _labelled(t: Roles) -> DataFrame:
    """Stored state: the labelled documents, with a field no batch carries."""
    return t.table("labels").select(
        F.col("doc_id").alias("review_id"), F.col("quality").cast("double").alias("score"), "toxic"
    )


def _batch(t: Roles) -> DataFrame:
    """All reviews twice; the second record of a key has a higher sequence number."""
    first = t.reviews.withColumn("seq", F.lit(1))
    second = t.reviews.withColumn("score", F.col("score") + 1).withColumn("seq", F.lit(2))
    return first.unionByName(second)


_MERGED_SQL = """select coalesce(n.review_id, o.review_id) as review_id,
    case when n.review_id is not null then n.score + 1 else cast(o.quality as double) end as score,
    o.toxic, n.content, n.at_text{extra}
    from v_reviews n full join (select doc_id as review_id, quality, toxic from labels) o
    on n.review_id = o.review_id"""


@job(_MERGED_SQL.format(extra=""))
def sink_upsert_by_key(t: Roles) -> DataFrame:
    table = scratch_dir(t.spark, "reviews")
    upsert_by_key(_labelled(t), table, "review_id", F.lit(0))
    fields = ["review_id", "content", "score", "at_text"]
    upsert_by_key(_batch(t), table, "review_id", F.col("seq"), fields)
    return read_keyed(t.spark, table)


@job("""select coalesce(n.review_id, o.review_id) as review_id,
    case when n.review_id is not null then n.score else o.score end as score,
    case when n.review_id is null then timestamp '2024-01-01'
    when o.review_id is null or n.score is distinct from o.score
    then timestamp '2024-02-01' else timestamp '2024-01-01' end as last_update
    from (select doc_id as review_id, cast(toxic as double) as score from labels) n
    full join (select doc_id as review_id, cast(quality as double) as score from labels
    union all select doc_id, 2.0 from documents where doc_id not in (select doc_id from labels)) o
    on n.review_id = o.review_id""")
def stamp_last_update(t: Roles) -> DataFrame:
    """Only rows whose fields change get the new stamp."""
    def scored(col: str) -> DataFrame:
        return t.table("labels").select(F.col("doc_id").alias("review_id"), F.col(col).cast("double").alias("score"))

    rest = t.table("documents").join(t.table("labels"), "doc_id", "left_anti")
    stored = scored("quality").unionAll(rest.select("doc_id", F.lit(2.0)))
    stored = stored.withColumn("last_update", F.lit("2024-01-01").cast("timestamp_ntz"))
    batch = last_per_key(scored("toxic"), "review_id", F.lit(0))
    return merge_by_key(stored, batch, "review_id", "last_update", F.lit("2024-02-01").cast("timestamp_ntz"))


# ---------------------------------------------------------------- file arrival
FILES = stream.ReviewLayout(columns={"review_id": "bigint", "content": "string", "score": "double", "at": "string"})


def _paths(t: Roles, archive: bool = False) -> stream.ReviewPaths:
    base = scratch_dir(t.spark, "arrivals")
    names = ("inbox", "table", "checkpoint", "log", "rejects")
    folders = {n: f"{base}/{n}" for n in names}
    return stream.ReviewPaths(**folders, archive=f"{base}/archive" if archive else None)


def _drop(df: DataFrame, paths: stream.ReviewPaths, name: str) -> None:
    write_csv(df, f"{paths.inbox}/{name}")


def _as_file(df: DataFrame) -> DataFrame:
    return df.select("review_id", "content", "score", F.col("at_text").alias("at"))


def _labelled_reviews(t: Roles) -> DataFrame:
    """Second arrival: the labelled reviews with their quality as score."""
    labels = t.table("labels").select(F.col("doc_id").alias("review_id"), F.col("quality").cast("double").alias("q"))
    return t.reviews.join(labels, "review_id").withColumn("score", F.col("q")).drop("q")


_REVIEW_SQL = f"""select review_id, {_cleaned_sql('content')} as content, score,
    try_strptime(at_text, '%Y-%m-%d %H:%M:%S') as "at" from v_reviews"""


@job("select review_id, nullif(content, '') as content, score, at_text as \"at\" from v_reviews")
def stream_file_arrival(t: Roles) -> DataFrame:
    """Rows as the file source hands them over, once each."""
    paths = _paths(t)
    _drop(_as_file(t.reviews), paths, "first")
    out = f"{paths.table}/raw"

    def store(lines: DataFrame, number: int) -> None:
        rows = stream.review_rows(lines, FILES)
        typed = rows.select(F.col("review_id").cast("bigint").alias("review_id"), "content", F.col("score").cast("double").alias("score"), "at")
        typed.write.mode("overwrite").parquet(f"{out}/batch={number}")

    lines = stream.arrivals(t.spark, paths, FILES).writeStream.foreachBatch(store)
    lines.option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out).drop("batch")


@job("""select 'empty' as outcome, cast(1 as bigint) as batches, cast(0 as bigint) as reviews
    union all select 'loaded', 1, count(*) from v_reviews""")
def stream_empty_branch(t: Roles) -> DataFrame:
    """A header-only arrival is logged and skipped, the next one is loaded."""
    paths = _paths(t)
    _drop(_as_file(t.reviews).where("false"), paths, "first")
    stream.run_once(t.spark, paths, FILES)
    _drop(_as_file(t.reviews), paths, "second")
    stream.run_once(t.spark, paths, FILES)
    loaded = read_keyed(t.spark, paths.table).agg(F.lit("loaded").alias("outcome"), F.count(F.lit(1)).alias("reviews"))
    batches = stream.outcomes(t.spark, paths).groupBy("outcome").agg(F.count(F.lit(1)).alias("batches"))
    joined = batches.join(loaded, "outcome", "left")
    return joined.select("outcome", "batches", F.coalesce("reviews", F.lit(0)).alias("reviews"))


@job(_REVIEW_SQL)
def stream_clean_chain(t: Roles) -> DataFrame:
    paths = _paths(t)
    _drop(_as_file(t.reviews), paths, "first")
    stream.run_once(t.spark, paths, FILES)
    return stream.ordered_export(read_keyed(t.spark, paths.table), FILES)


@job("select review_id, nullif(content, '') as content, score, at_text as \"at\" from v_reviews")
def stream_archive(t: Roles) -> DataFrame:
    """Files of a finished arrival lie in the archive once the next one is planned."""
    paths = _paths(t, archive=True)
    with session_setting(t.spark, "spark.sql.streaming.fileSource.cleaner.numThreads", "0"):
        _drop(_as_file(t.reviews), paths, "first")
        stream.run_once(t.spark, paths, FILES)
        for name in ("second", "third"):
            _drop(_as_file(_labelled_reviews(t)), paths, name)
            stream.run_once(t.spark, paths, FILES)
    fields = ", ".join(f"{c} {kind}" for c, kind in FILES.columns.items())
    archived = t.spark.read.schema(fields).options(**csv_options(True)).option("recursiveFileLookup", "true")
    return archived.csv(_archived(paths, "first"))


def _archived(paths: stream.ReviewPaths, name: str) -> str:
    """Archived files keep their full original path below the archive folder."""
    inbox = paths.inbox.split("://", 1)[-1]
    inbox = inbox if inbox.startswith("/") else "/" + inbox.split("/", 1)[-1]
    return f"{paths.archive}{inbox}/{name}"


@job(f"""with l as (select doc_id, cast(quality as double) as q from labels)
    select r.review_id, r.content, case when l.doc_id is null then r.score else l.q end as score, r."at"
    from ({_REVIEW_SQL}) r left join l on r.review_id = l.doc_id""")
def stream_upsert(t: Roles) -> DataFrame:
    """Two arrivals: the table ends with the last record per review."""
    paths = _paths(t)
    _drop(_as_file(t.reviews), paths, "first")
    stream.run_once(t.spark, paths, FILES)
    _drop(_as_file(_labelled_reviews(t)), paths, "second")
    stream.run_once(t.spark, paths, FILES)
    return read_keyed(t.spark, paths.table)

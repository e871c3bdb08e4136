"""Sources and sinks: what is written comes back the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates
from millrace.operators import rows
from millrace.plans.registry import job
from millrace.plans.roles import AS_OF, Roles
from millrace.plans.rooms import ALL_REPORTS_SQL, room_reports
from millrace.session import scratch_dir
from millrace.sources import readers, writers
from millrace.sources.tables import full_refresh

ROOM = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), False)]
)
STUDENT = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("birthday", T.DateType(), False),
        T.StructField("sex", T.StringType(), False),
        T.StructField("room", T.LongType(), False),
    ]
)
REVIEW = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("at_text", T.StringType()),
    ]
)


@job("select id, birthday, sex, room from v_students")
def src_json_array(t: Roles) -> DataFrame:
    path = scratch_dir(t.spark, "students")
    writers.write_json_arrays(t.students, "id", 50_000, path)
    return readers.json_arrays(t.spark, path, STUDENT)


@job("select review_id, nullif(content, '') as content, score, at_text from v_reviews")
def src_csv_header(t: Roles) -> DataFrame:
    path = scratch_dir(t.spark, "reviews")
    writers.write_csv(t.reviews, path)
    return readers.csv_with_header(t.spark, path, REVIEW)


@job("select doc_id, nullif(text, '') as text, lang, source, n_chars from documents")
def sink_csv(t: Roles) -> DataFrame:
    """Whole documents, with the line breaks and quotes of their texts."""
    path = scratch_dir(t.spark, "documents")
    table = t.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    writers.write_csv(table, path)
    cells = readers.csv_cells(t.spark, path, table.columns)
    return cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])


@job("select doc_id, quality, toxic from labels")
def src_csv_split(t: Roles) -> DataFrame:
    """Cells without line breaks: the files are split over tasks."""
    path = scratch_dir(t.spark, "labels")
    table = t.table("labels").select("doc_id", "quality", "toxic")
    writers.write_csv(table, path)
    return readers.csv_with_header(t.spark, path, table.schema, line_breaks=False)


@job("""select cast(generate_subscripts(embedding, 1) - 1 as int) as pos,
    cast(unnest(embedding) as double) as x from embeddings""")
def src_numeric_vector(t: Roles) -> DataFrame:
    """Each embedding as a line of numbers with blanks around some commas."""
    path = scratch_dir(t.spark, "vectors")
    numbers = F.transform("embedding", lambda x: x.cast("double").cast("string"))
    t.table("embeddings").select(F.array_join(numbers, " , ")).write.text(path)
    return readers.numeric_vectors(t.spark, path)


@job("""select 'rooms' as loaded, id, name, cast(null as date) as birthday, cast(null as varchar) as sex,
    cast(null as bigint) as room from v_rooms
    union all select 'students', id, null, birthday, sex, room from v_students""")
def sink_full_refresh(t: Roles) -> DataFrame:
    """Rooms and students reloaded twice: the second load leaves the same tables."""
    tag = uuid.uuid4().hex
    tables = {f"rooms_{tag}": (t.rooms, ROOM), f"students_{tag}": (t.students, STUDENT)}
    location = scratch_dir(t.spark, "refresh")
    full_refresh(t.spark, tables, location)
    full_refresh(t.spark, tables, location)
    rooms = t.spark.table(f"rooms_{tag}").withColumn("loaded", F.lit("rooms"))
    students = t.spark.table(f"students_{tag}").withColumn("loaded", F.lit("students"))
    both = rooms.unionByName(students, allowMissingColumns=True)
    return both.select("loaded", "id", "name", "birthday", "sex", "room")


def _stacked(t: Roles, folders: dict[str, str], read) -> DataFrame:
    """All reports of a written bundle as (report, name, value)."""
    out = None
    for name, columns in _REPORT_COLUMNS.items():
        df = read(folders[name], columns)
        value = F.col(columns[1]).cast("bigint") if len(columns) > 1 else F.lit(None).cast("bigint")
        part = df.select(F.lit(name).alias("report"), "name", value.alias("value"))
        out = part if out is None else out.unionAll(part)
    return out


_REPORT_COLUMNS = {
    "rooms_student_count": ["name", "student_count"],
    "smallest_avg_age_5": ["name", "avg_age"],
    "largest_age_dif_5": ["name", "age_dif"],
    "dif_sex_rooms": ["name"],
}


@job(ALL_REPORTS_SQL + " select report, name, value from reports")
def sink_json_report(t: Roles) -> DataFrame:
    bundle = room_reports(t.rooms, t.students, AS_OF)
    folders = writers.export_bundle(bundle, "json", scratch_dir(t.spark, "json"))

    def read(path: str, columns: list[str]) -> DataFrame:
        kinds = ["string", "bigint"]
        schema = ", ".join(f"{c} {k}" for c, k in zip(columns, kinds))
        return t.spark.read.schema(schema).json(path)

    return _stacked(t, folders, read)


@job(ALL_REPORTS_SQL + " select report, name, value from reports")
def sink_xml_report(t: Roles) -> DataFrame:
    bundle = room_reports(t.rooms, t.students, AS_OF)
    folders = writers.export_bundle(bundle, "xml", scratch_dir(t.spark, "xml"))
    return _stacked(t, folders, lambda path, columns: writers.read_xml_rows(t.spark, path, columns))


@job("""select case when payment_date >= timestamp '1995-01-01' and payment_date < timestamp '2001-07-01'
    then strftime(payment_date, '%Y-%m') else 'rejected' end as month,
    count(*) as n, cast(sum(amount) as double) as amount from v_payment group by 1""")
def sink_range_partitioned(t: Roles) -> DataFrame:
    """Payments by month of the declared range, read back through the month folders; the others are rejects."""
    path, rejects = scratch_dir(t.spark, "payments"), scratch_dir(t.spark, "rejects")
    writers.write_by_month(t.payment, "payment_date", "1995-01", "2001-06", path, rejects)
    months = writers.read_months(t.spark, path, "1995-01", "2001-06").select("month", "amount")
    refused = t.spark.read.parquet(rejects).select(F.lit("rejected").alias("month"), "amount")
    sums = months.unionByName(refused).groupBy("month")
    return sums.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


@job("select event_id, cast(json_extract(props, '$.k') as int) as k from events")
def src_semi_structured(t: Roles) -> DataFrame:
    events = t.table("events").select("event_id", "props")
    return readers.variant_fields(events, "props", k="$.k:int").select("event_id", "k")


@job("select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 200000")
def param_sql(t: Roles) -> DataFrame:
    return readers.select_with_parameters(
        t.spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status AND o_totalprice > :least",
        {"status": "F", "least": 200000.0},
        orders=t.table("orders"),
    )


# What a film row gets where a column is not given.
FILM_DEFAULTS = {"rental_duration": 3, "rental_rate": 4.99, "replacement_cost": 19.99, "rating": "G"}


@job("""select film_id, title, case when rental_duration = 7 then 3 else rental_duration end as rental_duration,
    case when length > 40 then 4.99 else cast(rental_rate as double) end as rental_rate,
    cast(19.99 as double) as replacement_cost, 'G' as rating from v_film""")
def fill_defaults(t: Roles) -> DataFrame:
    """Films with gaps and two absent columns get the declared defaults."""
    gappy = t.film.select(
        "film_id",
        "title",
        F.when(F.col("rental_duration") != 7, F.col("rental_duration")).alias("rental_duration"),
        F.when(F.col("length") <= 40, F.col("rental_rate").cast("double")).alias("rental_rate"),
    )
    return rows.fill_defaults(gappy, FILM_DEFAULTS).select(
        "film_id", "title", "rental_duration", "rental_rate", "replacement_cost", "rating"
    )


@job("select o_orderkey, last_day(o_orderdate) as month_end from orders")
def month_end(t: Roles) -> DataFrame:
    return t.table("orders").select("o_orderkey", dates.month_end(F.col("o_orderdate")).alias("month_end"))


@job("""select event_id, unnest(json_keys(props)) as key, json_extract_string(props, unnest(json_keys(props))) as value
    from events""")
def src_document_keys(t: Roles) -> DataFrame:
    """The keys of stored JSON documents as rows, with their values as text."""
    path = scratch_dir(t.spark, "documents")
    readers.variant_documents(t.table("events").select("event_id", "props"), "props").write.parquet(path)
    entries = readers.variant_entries(t.spark.read.parquet(path), "document")
    return entries.select("event_id", "key", F.col("value").cast("string").alias("value"))


@job("""select l_orderkey as order_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey nulls first, l_suppkey,
    l_quantity, l_extendedprice) - 1 as pos, l_linenumber as number, cast(l_quantity as double) as quantity, l_partkey as part
    from lineitem join orders on o_orderkey = l_orderkey""")
def src_nested_documents(t: Roles) -> DataFrame:
    """Orders as nested documents, stored as VARIANT: the elements of their arrays as rows."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = t.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    nested = t.table("orders").select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey")
    path = scratch_dir(t.spark, "orders")
    text = F.to_json(F.struct("o_orderkey", "o_orderstatus", "lines"))
    readers.variant_documents(nested.select(text.alias("json")), "json").write.parquet(path)
    stored = t.spark.read.parquet(path)
    order = F.variant_get("document", "$.o_orderkey", "bigint")
    entries = readers.variant_entries(stored.withColumn("order_id", order), "document", "$.lines")
    field = lambda name, kind: F.try_variant_get("value", f"$.l_{name}", kind)
    return entries.select(
        "order_id",
        F.col("pos").cast("bigint").alias("pos"),
        field("linenumber", "bigint").alias("number"),
        field("quantity", "double").alias("quantity"),
        field("partkey", "bigint").alias("part"),
    )

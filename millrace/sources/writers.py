"""File sinks. Every writer leaves one folder that Spark reads back as a whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from millrace.functions.dates import month_key
from millrace.session import written
from millrace.sources.readers import CSV_OPTIONS

_JSON_TYPES = (T.StringType, T.BooleanType, T.NumericType)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no row numbers; missing cells are empty."""
    df.write.options(**CSV_OPTIONS).csv(path)


def write_json_arrays(df: DataFrame, key: str, rows_per_file: int, path: str) -> None:
    """JSON array files; each holds rows of one range of a whole-number key, or rows without a key.

    A file is written line by line from sorted rows, so no array is held in memory. Ranges with many
    more rows than ``rows_per_file``, as of a key that repeats or of missing keys, are dealt over several files.
    """
    label = F.coalesce(F.expr(f"`{key}` div {rows_per_file}").cast("string"), F.lit("none"))
    rows = df.select(label.alias("range"), F.to_json(F.struct(*df.columns)).alias("value"))
    files = F.ceil(F.count(F.lit(1)) / F.lit(2.0 * rows_per_file))
    sizes = rows.groupBy("range").agg(files.alias("files"))
    turn = F.pmod(F.monotonically_increasing_id(), F.col("files"))
    part = F.when(F.col("files") > 1, F.concat_ws("-", "range", turn.cast("string"))).otherwise(F.col("range")).alias("part")
    rows = rows.join(sizes, "range").select(part, "value")
    number = F.row_number().over(Window.partitionBy("part").orderBy("value")).cast("bigint")
    mark = F.when(number == 1, "[").otherwise(",")
    lines = written(rows.select("part", number.alias("at"), F.concat(mark, "value").alias("value")), "json-lines")
    ends = lines.groupBy("part").agg(F.max("at").alias("at"))
    closed = lines.unionByName(ends.select("part", F.col("at") + 1, F.lit("]").alias("value")).toDF("part", "at", "value"))
    dealt = closed.repartition("part").sortWithinPartitions("part", "at")
    dealt.select("part", "value").write.partitionBy("part").text(path)


def export_bundle(bundle: Mapping[str, DataFrame], kind: str, path: str) -> dict[str, str]:
    """Write named results as JSON or XML, one folder per name; returns the folders."""
    if not bundle:
        raise ValueError("nothing to export")
    if kind.lower() not in ("json", "xml"):
        raise ValueError(f"unsupported format {kind!r}: use 'json' or 'xml'")
    writer = _write_json if kind.lower() == "json" else _write_xml
    folders = {name: f"{path}/{name}" for name in bundle}
    for name, df in bundle.items():
        writer(df, name, folders[name])
    return folders


def _write_json(df: DataFrame, name: str, path: str) -> None:
    columns = []
    for field in df.schema.fields:
        if not isinstance(field.dataType, _JSON_TYPES + (T.ArrayType, T.MapType, T.StructType, T.NullType)):
            raise TypeError(f"{name}.{field.name}: {field.dataType.simpleString()} has no JSON form")
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    df.select(*columns).write.option("ignoreNullFields", "false").json(path)


def _write_xml(df: DataFrame, name: str, path: str) -> None:
    """Each record a ``row``, each value as text, a missing one as ``None``."""
    cells = [_as_text(f).alias(f.name) for f in df.schema.fields]
    df.select(*cells).write.format("xml").options(rootTag=name, rowTag="row", nullValue="None").save(path)


def _as_text(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    return value.cast("string")


def read_xml_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.format("xml").schema(schema).options(rowTag="row", nullValue="None").load(path)


def write_by_month(df: DataFrame, ts: str, first: str, last: str, path: str, rejects: str | None = None) -> None:
    """Write the rows of the declared months (``yyyy-MM``) partitioned by month.

    A row outside of them, or without a timestamp, fails the job: no default
    partition takes it. With ``rejects``, such rows are written to that folder instead.
    The rebalance hint gives each month files of a sensible size and splits a
    month that holds most of the rows.
    """
    month = month_key(F.col(ts))
    inside = F.coalesce(month.between(first, last), F.lit(False))
    if rejects is None:
        what = F.concat(F.lit(f"no partition for {ts} "), F.coalesce(F.col(ts).cast("string"), F.lit("NULL")))
        month = F.when(inside, month).otherwise(F.raise_error(what).cast("string"))
        kept = df.withColumn("month", month)
    else:
        df.where(~inside).write.parquet(rejects)
        kept = df.where(inside).withColumn("month", month)
    kept.hint("rebalance", "month").write.partitionBy("month").parquet(path)


def read_months(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Rows of a range of months; other months are pruned before the scan."""
    return spark.read.parquet(path).withColumn("month", F.col("month").cast("string")).where(
        F.col("month").between(first, last)
    )

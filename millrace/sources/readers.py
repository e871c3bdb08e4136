"""Typed readers."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import nan_to_null
from millrace.functions.text import DEFAULT_MISSING
from millrace.operators.rows import null_missing_cells
from millrace.sources.pieces import read_csv_records, read_json_elements

# Quoted cells may hold doubled quotes; blanks are kept.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # Compare the header with the declared names: a file in another order fails.
    "enforceSchema": "false",
}


def csv_options(line_breaks: bool) -> dict[str, str]:
    """Options of Spark's own reader, which reads a file with line breaks in its cells in one task."""
    return CSV_OPTIONS | {"multiLine": str(line_breaks).lower()}


def json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that are one JSON array of objects each; only the named fields are read.

    A large file is read by many tasks.
    """
    rows = read_json_elements(spark, path).select(F.from_json("value", schema).alias("_row"))
    return rows.select(*(F.col("_row").getField(name).alias(name) for name in schema.names))


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def parsed_csv(records: DataFrame, columns: Sequence[str], corrupt: str | None = None) -> DataFrame:
    """The cells of CSV records as text beside the other columns; header records are compared with the names and go.

    With ``corrupt``, that column holds the text of records with too many or too few cells.
    """
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema")}
    # One cell more than there are names, to see that it is empty.
    header = F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(columns) + 1)), options)
    given = F.array(*(F.lower(header.getField(f"c{i}")) for i in range(len(columns) + 1)))
    same = given.eqNullSafe(F.array(*(F.lit(c.lower()) for c in columns), F.lit(None)))
    message = F.concat(F.lit(f"the CSV header isn't {','.join(columns)}: "), "value")
    wanted = F.when(F.col("_header"), F.when(same, False).otherwise(F.raise_error(message).cast("boolean"))).otherwise(True)
    if corrupt:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    names = [*columns, *([corrupt] if corrupt else [])]
    fields = ", ".join(f"`{n}` string" for n in names)
    cells = records.where(wanted).withColumn("_cells", F.from_csv("value", fields, options))
    others = [c for c in records.columns if c not in ("value", "_header")]
    return cells.select(*(F.col("_cells").getField(n).alias(n) for n in names), *others)


def csv_cells(spark: SparkSession, path: str, columns: Sequence[str], line_breaks: bool = True) -> DataFrame:
    """All cells of CSV files as text. Large files are read by many tasks.

    Say that no cell holds line breaks where that is so: a line is a record then, and nothing is shuffled.
    """
    if line_breaks:
        return parsed_csv(read_csv_records(spark, path), columns).select(*columns)
    raw = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(raw).options(**csv_options(False)).csv(path)


def csv_with_header(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    tokens: tuple[str, ...] = DEFAULT_MISSING,
    line_breaks: bool = True,
) -> DataFrame:
    """CSV with a declared schema; missing-value texts become NULL, untrimmed.

    Non-text columns are read as text first, so that a missing-value text in
    them is NULL and any other unreadable value still fails.
    """
    cells = null_missing_cells(csv_cells(spark, path, schema.names, line_breaks), tokens)
    return cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def numeric_vectors(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Header-less lines of delimited numbers as rows (pos, x), blanks allowed.

    Each line is one vector; positions count from zero in each.
    """
    cells = spark.read.text(path).where(F.trim("value") != "")
    cells = cells.select(F.posexplode(F.split("value", separator)).alias("pos", "cell"))
    return cells.select("pos", F.trim("cell").cast("double").alias("x"))


def literal_rows(spark: SparkSession, values: Sequence[Any], position: str, name: str) -> DataFrame:
    """A short fixed list as rows with positions from zero, known to be small."""
    listed = F.array(*[F.lit(v) for v in values])
    return spark.range(1).select(F.posexplode(listed).alias(position, name))


def variant_fields(df: DataFrame, json: str, **fields: str) -> DataFrame:
    """Parse a JSON text column once and pull typed fields out of it.

    ``fields`` maps a column name to ``"path:type"``, e.g. ``k="$.k:int"``.
    """
    parsed = df.withColumn("_doc", F.parse_json(json))
    picked: dict[str, Column] = {}
    for name, spec in fields.items():
        path, kind = spec.rsplit(":", 1)
        picked[name] = F.variant_get("_doc", path, kind)
    return parsed.withColumns(picked).drop("_doc")


def variant_documents(df: DataFrame, json: str, name: str = "document") -> DataFrame:
    """The rows with a JSON text column parsed to VARIANT, which Parquet stores as such. Broken texts are NULL."""
    return df.withColumn(name, F.try_parse_json(json)).drop(*([json] if json != name else []))


def variant_entries(df: DataFrame, document: str, path: str = "$", keep_empty: bool = False) -> DataFrame:
    """A row for each element of an array or key of an object at a path: other columns, ``pos``, ``key`` (NULL in arrays), ``value`` (VARIANT).

    A document without the path, or with neither array nor object there, gives no row; with ``keep_empty``, one without entry.
    """
    at = F.try_variant_get(document, path, "variant")
    part = F.when(F.schema_of_variant(at).rlike("^(ARRAY|OBJECT)<"), at)
    inner = df.withColumn("_at", part)
    tvf = df.sparkSession.tvf
    entries = (tvf.variant_explode_outer if keep_empty else tvf.variant_explode)(F.col("_at").outer())
    return inner.lateralJoin(entries).drop("_at")


def merged_schema(df: DataFrame, document: str) -> str:
    """The type that fits all documents, as text; where types don't fit one another it says VARIANT."""
    return df.agg(F.schema_of_variant_agg(document)).first()[0]


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in all floating-point columns."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floats})


def select_with_parameters(
    spark: SparkSession, text: str, parameters: dict[str, Any], **frames: DataFrame
) -> DataFrame:
    """Run a SELECT over the given frames with bound ``:name`` parameters.

    Frames are named ``{name}`` in the text.
    """
    return spark.sql(text, args=parameters, **frames)

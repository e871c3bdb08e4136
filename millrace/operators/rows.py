"""Row filters and rewrites that need at most one small aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_cell, missing_to_null


def filter_equals(df: DataFrame, **wanted: Any) -> DataFrame:
    for name, value in wanted.items():
        df = df.where(F.col(name) == value)
    return df


def filter_prefix_or_infix(
    df: DataFrame, prefix_col: str, prefix: str, infix_col: str, infix: str
) -> DataFrame:
    """Rows that match either pattern, each once. The prefix ignores case."""
    return df.where(
        F.col(prefix_col).ilike(f"{prefix}%") | F.col(infix_col).like(f"%{infix}%")
    )


def filter_at_max(df: DataFrame, col: str) -> DataFrame:
    """Rows that hold the largest value; the maximum is a scalar subquery."""
    top = df.agg(F.max(col)).scalar()
    return df.where(F.col(col) == top)


def all_in_list(df: DataFrame, col: str, values: Sequence[Any], name: str) -> DataFrame:
    """One row: is every value in the list? Missing counts as outside, no rows as true."""
    inside = F.coalesce(F.col(col).isin(*values), F.lit(False))
    return df.agg(F.coalesce(F.bool_and(inside), F.lit(True)).alias(name))


def zero_at_max(df: DataFrame, series: str, value: str, name: str) -> DataFrame:
    """Replace every occurrence of a series' largest value by zero.

    The maxima are one row per series, so a hot series meets a single row and
    the adaptive skew join may split its side freely. A missing series is one, too.
    """
    tops = df.groupBy(series).agg(F.max(value).alias("_top"))
    replaced = F.when(F.col(value) == F.col("_top"), 0).otherwise(F.col(value))
    tops = tops.withColumnRenamed(series, "_series")
    both = df.join(tops, df[series].eqNullSafe(tops["_series"]))
    return both.withColumn(name, replaced).drop("_top", "_series")


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Put a column's default where it is missing, add the column if absent.

    A default is a plain value or a column, such as the current date.
    """
    filled = {}
    for name, default in defaults.items():
        value = default if isinstance(default, Column) else F.lit(default)
        filled[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(filled)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")]


def null_missing_cells(df: DataFrame, tokens: tuple[str, ...], columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value texts to NULL in the named, else in all text columns."""
    names = text_columns(df) if columns is None else columns
    return df.withColumns({c: missing_to_null(F.col(c), tokens) for c in names})


def clean_missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim text columns and mark their missing cells; numeric gaps stay NULL."""
    names = text_columns(df) if columns is None else columns
    return df.withColumns({c: clean_cell(F.col(c)) for c in names})


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First rows in the given order; a distributed table has no order of its own."""
    return df.orderBy(*order).limit(n)


def sort_by_ts_nulls_last(df: DataFrame, ts: str, *tie_break: str) -> DataFrame:
    """Ascending by timestamp, missing last; unchanged where the column is absent.

    The tie-break columns also split the range partition of a frequent (or
    missing) timestamp, so give at least one that varies.
    """
    if ts not in df.columns:
        return df
    return df.orderBy(F.col(ts).asc_nulls_last(), *tie_break)

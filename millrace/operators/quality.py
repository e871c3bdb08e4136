"""Data-quality checks: each returns the violating rows or a small summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A check that has to hold found violations."""


def duplicate_keys(df: DataFrame, key: Sequence[str], name: str = "copies") -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is given but has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per mandatory column with the number of missing values, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, missing)")


def outside_range(df: DataFrame, col: str, low: Any, high: Any) -> DataFrame:
    """Rows whose value lies outside low to high, both included."""
    return df.where(~F.col(col).between(low, high))


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    broken = F.lit(False)
    for col, limit in limits.items():
        broken = broken | F.coalesce(F.length(col) > limit, F.lit(False))
    return df.where(broken)


def not_in_enum(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    return df.where(~F.col(col).isin(*values))


def violation_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violations."""
    rows = None
    for name, found in checks.items():
        row = found.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations"))
        rows = row if rows is None else rows.unionAll(row)
    if rows is None:
        raise ValueError("no checks given")
    return rows


def require_none(found: DataFrame, rule: str) -> None:
    """Stop the job if a check found anything."""
    if not found.isEmpty():
        raise QualityError(f"{rule}: violations found")

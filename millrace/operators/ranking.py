"""Top lists over aggregates, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_with_ties(df: DataFrame, measure: str, n: int) -> DataFrame:
    """The n rows with the largest measure plus all rows that tie with the last."""
    cut = df.select(measure).orderBy(F.desc(measure)).limit(n).agg(F.min(measure)).scalar()
    return df.where(F.col(measure) >= cut)


def top_distinct(df: DataFrame, measure: str, k: int) -> DataFrame:
    """Rows whose measure is among the k largest distinct values (dense rank <= k)."""
    cut = (
        df.select(measure).distinct().orderBy(F.desc(measure)).limit(k).agg(F.min(measure)).scalar()
    )
    return df.where(F.col(measure) >= cut)


def group_top_with_ties(df: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    """Rows that lead their group under a descending sort with NULL first.

    The best measure of a group is a partial aggregate; matching it on group
    and measure together leaves no task with a whole group to sort.
    """
    best = df.groupBy(*group).agg(
        F.bool_or(F.col(measure).isNull()).alias("_null"), F.max(measure).alias("_max")
    )
    best = best.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.when(~F.col("_null"), F.col("_max")).alias("_best"),
    )
    same = F.col(measure).eqNullSafe(F.col("_best"))
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return df.join(best, same, "left_semi")


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """LIMIT after a sort; end the order with a unique column."""
    return df.orderBy(*order).limit(k)

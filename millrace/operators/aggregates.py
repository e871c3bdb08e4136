"""Grouped statistics.

Every first step is an aggregate with partial results on the map side, so a
hot group is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keys import assign_keys
from millrace.session import written
from millrace.functions.arrays import diagonal_element
from millrace.sources.readers import literal_rows


def _present(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per value, missing left out, most frequent first."""
    counts = _present(df, col).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), col)


def value_shares(df: DataFrame, col: str, name: str = "share") -> DataFrame:
    """Share of each value among the rows that have one."""
    counts = _present(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.select(col, (F.col("_n") / total).alias(name))


def group_value_shares(df: DataFrame, group: str, col: str, name: str = "share") -> DataFrame:
    """Share of each value within its group."""
    counts = _present(df, group, col).groupBy(group, col).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(group).agg(F.sum("_n").alias("_all"))
    return counts.join(totals, group).select(group, col, (F.col("_n") / F.col("_all")).alias(name))


def larger_share(
    df: DataFrame, group: str, col: str, value: Any, first: str, second: str, name: str = "larger"
) -> DataFrame:
    """Which of two groups has the larger share of a value; the second on a tie."""
    shares = group_value_shares(df, group, col).where(F.col(col) == value)

    def share_of(label: str) -> Column:
        return F.max(F.when(F.col(group) == label, F.col("share")))

    won = share_of(first) > share_of(second)
    return shares.agg(F.when(won, F.lit(first)).otherwise(F.lit(second)).alias(name))


def group_sizes(df: DataFrame, group: str, name: str = "n") -> DataFrame:
    return _present(df, group).groupBy(group).agg(F.count(F.lit(1)).alias(name))


def group_sizes_declared(df: DataFrame, group: str, labels: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per declared label, zero for a label without rows."""
    declared = literal_rows(df.sparkSession, labels, "_order", group)
    sized = declared.join(group_sizes(df, group, name), group, "left")
    return sized.orderBy("_order").select(group, F.coalesce(F.col(name), F.lit(0)).alias(name))


def group_with_top_share(
    df: DataFrame, group: str, col: str, value: Any, labels: Sequence[str], name: str = "top"
) -> DataFrame:
    """Declared group with the largest share of a value, the first one on a tie."""
    shares = group_value_shares(df, group, col).where(F.col(col) == value)
    order = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(group))
    return shares.orderBy(F.desc("share"), order).limit(1).select(F.col(group).alias(name))


def mean_std(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and sample deviation per group; one row alone has no deviation."""
    return _present(df, group).groupBy(group).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )


def group_means(df: DataFrame, groups: Sequence[str], value: str, name: str = "mean") -> DataFrame:
    return _present(df, *groups).groupBy(*groups).agg(F.avg(value).alias(name))


def mean_where(df: DataFrame, condition: Column, value: str, name: str = "mean") -> DataFrame:
    return df.where(condition).agg(F.avg(value).alias(name))


def stat_of_group(df: DataFrame, stat: Column, **group: Any) -> DataFrame:
    """One statistic of one group; the group filter comes before the aggregate."""
    for name, value in group.items():
        df = df.where(F.col(name) == value)
    return df.agg(stat)


def keep_groups(df: DataFrame, group: str, condition: Column) -> DataFrame:
    """All rows of the groups whose aggregates meet the condition."""
    kept = _present(df, group).groupBy(group).agg(condition.alias("_kept")).where("_kept")
    return df.join(kept.select(group), group, "left_semi")


def all_rows(condition: Column) -> Column:
    """Aggregate: does every row meet the condition? A missing value does not."""
    return F.bool_and(F.coalesce(condition, F.lit(False)))


def distinct_by_parent(
    parents: DataFrame, key: str, label: str, links: DataFrame, item: str, name: str = "n"
) -> DataFrame:
    """Distinct linked items per parent label, zero included, largest first."""
    pairs = links.select(key, item).join(parents.select(key, label), key)
    counts = pairs.groupBy(label).agg(F.count_distinct(item).alias(name))
    labels = parents.select(label).distinct()
    out = labels.join(counts, labels[label].eqNullSafe(counts[label]), "left").select(
        labels[label], F.coalesce(F.col(name), F.lit(0)).alias(name)
    )
    return out.orderBy(F.desc(name), label)


def concat_texts(df: DataFrame, keys: Sequence[str], text: str, name: str, distinct: bool = False) -> DataFrame:
    """Texts of a group in one cell, joined by a comma; NULL if it has none.

    The cell is the result itself, so a group has to fit one value. Distinct
    texts are reduced on the map side first.
    """
    rows = df.select(*keys, text)
    if distinct:
        rows = rows.distinct()
    joined = F.expr(f"listagg(`{text}`, ', ') within group (order by `{text}`)")
    return rows.groupBy(*keys).agg(joined.alias(name))


def listed_texts(df: DataFrame, keys: Sequence[str], text: str, name: str = "position") -> DataFrame:
    """The long form of ``concat_texts``: each text with its place in its group, from 1.

    The rows are sorted by range over all tasks, and a place is the distance to the group's first
    row, so no task holds a group. Groups with a missing key are left out.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    placed = assign_keys(df.select(*keys, text), [*keys, text], "_at")
    firsts = placed.groupBy(*keys).agg(F.min("_at").alias("_first"))
    both = placed.join(firsts, list(keys))
    return both.select(*keys, (F.col("_at") - F.col("_first") + 1).alias(name), text)


def most_frequent_texts(df: DataFrame, text: str, k: int = 5, name: str = "n") -> DataFrame:
    """The k most frequent texts, missing as a group of its own, ties by text.

    Counting runs on digests, so whole texts do not go through the shuffle.
    Texts are fetched only for digests that reach the k-th count. The counts are
    written once, so the texts are read twice and hashed twice, whatever repeats.
    """
    # A digest has 32 bytes, so the empty one can stand for a missing text.
    digest = F.unhex(F.coalesce(F.sha2(F.col(text), 256), F.lit("")))
    keyed = df.select(F.col(text), digest.alias("_digest"))
    counts = written(keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias(name)), "digests")
    cut = counts.select(name).orderBy(F.desc(name)).limit(k).agg(F.min(name)).scalar()
    leading = counts.where(F.col(name) >= cut)
    texts = keyed.join(leading, "_digest").groupBy("_digest", name).agg(F.max(text).alias(text))
    return texts.orderBy(F.desc(name), F.col(text).asc_nulls_first()).limit(k).select(text, name)


def mean_per_day(df: DataFrame, day: Column, score: Column, name: str = "avg_score") -> DataFrame:
    """Plain mean of the scores that are numbers, per day; the rows without a day are one group."""
    return df.groupBy(day.alias("day")).agg(F.avg(score.try_cast("double")).alias(name))


def diagonal_product(df: DataFrame, row_index: str, row: str, matrix: Sequence[str] = ()) -> DataFrame:
    """Product of the non-zero elements (i, i) of each matrix, 0 if there is none."""
    element = diagonal_element(F.col(row), F.col(row_index)).cast("double")
    placed = df.select(*matrix, element.alias("_e"))
    product = F.product(F.when(F.col("_e") != 0, F.col("_e")))
    return placed.groupBy(*matrix).agg(F.coalesce(product, F.lit(0.0)).alias("product"))


def first_index_of_rows(df: DataFrame, cols: Sequence[str], index: str, name: str = "first_index") -> DataFrame:
    """Distinct rows in value order with the index of their first occurrence."""
    return df.groupBy(*cols).agg(F.min(index).alias(name)).orderBy(*cols)


def distinct_in_order(df: DataFrame, col: str, position: str) -> DataFrame:
    """Distinct values in the order in which they first appear."""
    firsts = df.groupBy(col).agg(F.min(position).alias("_first"))
    return firsts.orderBy("_first", col).select(col)


def same_multiset(left: DataFrame, right: DataFrame, name: str = "same") -> DataFrame:
    """One row: do both one-column frames hold the same values equally often?"""
    signed = left.select(F.col(left.columns[0]).alias("v"), F.lit(1).alias("s")).unionAll(
        right.select(F.col(right.columns[0]).alias("v"), F.lit(-1).alias("s"))
    )
    surplus = signed.groupBy("v").agg(F.sum("s").alias("s")).where("s <> 0")
    return surplus.agg((F.count(F.lit(1)) == 0).alias(name))

"""Join-shaped operators.

The side that can hold a hot key is aggregated to one row per key before it
meets the other table. Broadcasts are left to the size checks of the optimizer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import mul

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.keys import assign_keys


def join_chain(first: DataFrame, *steps: tuple[DataFrame, str | list[str]]) -> DataFrame:
    """Inner equi joins along columns of the same name."""
    return reduce(lambda left, step: left.join(step[0], step[1]), steps, first)


def child_counts(
    parents: DataFrame, parent_key: str, children: DataFrame, child_key: str, name: str
) -> DataFrame:
    """Number of children per parent row, zero for a parent without any."""
    per_key = children.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias(name))
    joined = parents.join(per_key, parents[parent_key] == per_key["_key"], "left").drop("_key")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def without_match(df: DataFrame, other: DataFrame, key: str | list[str]) -> DataFrame:
    return df.join(other, key, "left_anti")


def open_rentals(rental: DataFrame) -> DataFrame:
    return rental.where(F.col("return_date").isNull())


def in_stock(inventory: DataFrame, rental: DataFrame, film_id: int | None = None, store_id: int | None = None) -> DataFrame:
    """Inventory items that no open rental holds, of one film and store or of all."""
    held = open_rentals(rental).select("inventory_id").distinct()
    return _items(inventory, film_id, store_id).join(held, "inventory_id", "left_anti")


def not_in_stock(inventory: DataFrame, rental: DataFrame, film_id: int | None = None, store_id: int | None = None) -> DataFrame:
    held = open_rentals(rental).select("inventory_id").distinct()
    return _items(inventory, film_id, store_id).join(held, "inventory_id", "left_semi")


def _items(inventory: DataFrame, film_id: int | None, store_id: int | None) -> DataFrame:
    if film_id is not None:
        inventory = inventory.where(F.col("film_id") == film_id)
    if store_id is not None:
        inventory = inventory.where(F.col("store_id") == store_id)
    return inventory


def stock_flags(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Every item with its stock flag: true unless an open rental holds it."""
    held = open_rentals(rental).select("inventory_id").distinct().withColumn("_held", F.lit(True))
    flag = F.col("_held").isNull()
    return inventory.join(held, "inventory_id", "left").withColumn("in_stock", flag).drop("_held")


def holders(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Every item with the customer of its open rental, the smallest id if several."""
    held = open_rentals(rental).groupBy("inventory_id").agg(F.min("customer_id").alias("customer_id"))
    return inventory.join(held, "inventory_id", "left")


def all_combinations(lists: Sequence[tuple[DataFrame, str]], position: str = "position") -> DataFrame:
    """Every combination of the lists' distinct values, the last varying fastest.

    Each value list gets dense positions; combination number ``n`` is decoded
    into one position per list and looked up by equi joins. So the work is
    spread over the numbers of the combinations, not over a nested loop.
    """
    keyed, sizes = [], []
    for i, (values, col) in enumerate(lists):
        numbered = assign_keys(values.select(col).distinct(), [col], f"_at{i}", start=0)
        keyed.append(numbered)
        sizes.append((numbered.agg(F.max(f"_at{i}")).first()[0] or 0) + 1 if not numbered.isEmpty() else 0)
    out = values_range(lists[0][0], reduce(mul, sizes, 1), position)
    stride = reduce(mul, sizes, 1)
    for i, size in enumerate(sizes):
        stride //= max(size, 1)
        digit = F.expr(f"({position} div {max(stride, 1)}) % {max(size, 1)}")
        out = out.withColumn(f"_at{i}", digit)
    for i, numbered in enumerate(keyed):
        out = out.join(numbered, f"_at{i}")
    return out.select(position, *[col for _, col in lists])


def values_range(like: DataFrame, n: int, name: str) -> DataFrame:
    return like.sparkSession.range(n).select(F.col("id").alias(name))

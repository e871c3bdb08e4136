"""Array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def meets_every_set(row: Column, sets: Sequence[Sequence[int]]) -> Column:
    """True where the row shares an element with each of the given sets."""
    met = F.lit(True)
    for members in sets:
        met = met & F.arrays_overlap(row, F.array(*[F.lit(m) for m in members]))
    return met


def not_constant(row: Column) -> Column:
    """True where the row holds at least two different values."""
    return F.array_max(row) > F.array_min(row)


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two equally long vectors, term by term."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))


def diagonal_element(row: Column, row_index: Column) -> Column:
    """Element (i, i) of row i counted from zero; NULL beyond the row's end."""
    return F.get(row, row_index.cast("int"))

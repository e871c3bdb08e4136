"""Groups kept by a user's own function.

The function is given as three parts: ``fold`` turns some rows of a group (a pandas frame) and a state into the next
state, ``merge`` puts two states together, ``keep`` decides by the last one. Tasks fold the rows they have, whatever
groups these belong to, and send one state for each group they met; so a group that holds most rows is folded by
many tasks, and only states are shuffled. What the built-in functions can say is better said as a column
(``aggregates.keep_groups``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HELD_STATES = 10_000


@dataclass(frozen=True)
class GroupRule:
    """A decision over whole groups, of whose rows no more than a batch is seen at a time."""

    start: Callable[[], Any]
    fold: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    keep: Callable[[Any], bool]


def kept_groups(df: DataFrame, group: Sequence[str], columns: Sequence[str], rule: GroupRule) -> DataFrame:
    """The groups (distinct values of the group columns, all there) that the rule keeps; ``columns`` are what it sees."""
    rows = df.select(*group, *(c for c in columns if c not in group)).dropna(subset=list(group))
    names = [f"g{i}" for i in range(len(group))]
    kinds = [T.StructField(n, rows.schema[g].dataType) for n, g in zip(names, group)]
    states = T.StructType([*kinds, T.StructField("state", T.BinaryType())])

    def send(held: dict, schema: pa.Schema) -> pa.RecordBatch:
        keys = list(held)
        arrays = [pa.array([k[i] for k in keys], schema.field(i).type) for i in range(len(group))]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([pickle.dumps(held[k]) for k in keys], pa.binary())], [*names, "state"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, schema = {}, None
        for batch in batches:
            schema = batch.schema
            # Rows are dealt to their groups by number, as a group value may be of any type.
            numbers: dict = {}
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(group)))))
            at = [numbers.setdefault(k, len(numbers)) for k in keys]
            order = list(numbers)
            for number, part in batch.to_pandas().groupby(pd.Series(at, dtype="int64"), sort=False):
                key = order[number]
                held[key] = rule.fold(held[key] if key in held else rule.start(), part)
            if len(held) > HELD_STATES:
                yield send(held, schema)
                held = {}
        if held:
            yield send(held, schema)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States of a group stand together: one state is held."""
        key = state = None
        for batch in batches:
            kept = []
            found = list(zip(*(batch.column(i).to_pylist() for i in range(len(group)))))
            for k, raw in zip(found, batch.column(len(group)).to_pylist()):
                if k != key:
                    if key is not None and rule.keep(state):
                        kept.append(key)
                    key, state = k, pickle.loads(raw)
                else:
                    state = rule.merge(state, pickle.loads(raw))
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], batch.schema.field(i).type) for i in range(len(group))], names)
            schema = batch.schema
        if key is not None and rule.keep(state):
            yield pa.RecordBatch.from_arrays([pa.array([key[i]], schema.field(i).type) for i in range(len(group))], names)

    folded = rows.mapInArrow(fold, states)
    dealt = folded.repartition(*names).sortWithinPartitions(*names)
    found = dealt.mapInArrow(decide, T.StructType(kinds))
    return found.select(*(F.col(n).alias(g) for n, g in zip(names, group)))


def keep_groups_by(df: DataFrame, group: Sequence[str], columns: Sequence[str], rule: GroupRule) -> DataFrame:
    """The rows of the groups that the rule keeps; rows with a missing group value go."""
    return df.join(kept_groups(df, group, columns, rule), list(group), "left_semi")

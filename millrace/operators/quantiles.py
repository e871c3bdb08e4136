"""Exact quantiles and distribution statistics.

The built-in exact percentile keeps every distinct value of a group in one
task. That is fine for a column with few values and wrong for a measure, so
``exact_quantiles`` sorts the values by range over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.session import written

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles: one row per group and probability.

    1. Equal values of a group are counted, then range-sorted by group and value
       and written with their partition.
    2. Row counts of each (group, partition) tell which partition holds a rank.
    3. Only these partitions' rows get a running count, each partition for itself.

    No task sees more of a group than one range partition. Result columns: the
    keys, ``prob``, ``quantile``. Missing values and groups with a missing key
    are left out.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    counts = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_m"))
    ranged = counts.repartitionByRange(*keys, "_v").sortWithinPartitions(*keys, "_v")
    marked = written(ranged.withColumn("_mark", F.monotonically_increasing_id()), "quantiles")
    stored = marked.withColumn("_part", F.shiftright("_mark", _LOCAL_BITS)).drop("_mark")

    # One row per group and range partition that holds some of it.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy(*keys, "_part").agg(F.sum("_m").alias("_n"))
    parts = parts.withColumns(
        {"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_all": F.sum("_n").over(Window.partitionBy(*keys))}
    )
    wanted = parts.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    at = (F.col("_all") - 1) * F.col("prob")
    wanted = wanted.withColumn("_low", F.floor(at)).withColumn("_frac", at - F.floor(at))
    wanted = wanted.withColumn(
        "_rank", F.explode(F.array(F.col("_low"), F.least(F.col("_low") + 1, F.col("_all") - 1)))
    )
    wanted = wanted.where(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    )

    place = [*keys, "_part"]
    by_value = Window.partitionBy(*place).orderBy("_v")
    values = stored.join(wanted.select(*place).distinct(), place, "left_semi")
    values = values.withColumn("_to", F.sum("_m").over(by_value))
    local = F.col("_rank") - F.col("_before")
    found = values.join(wanted.select(*place, "prob", "_low", "_frac", "_rank", "_before"), place).where(
        (local < F.col("_to")) & (local >= F.col("_to") - F.col("_m"))
    )
    is_low = F.col("_rank") == F.col("_low")
    per_prob = found.groupBy(*keys, "prob").agg(
        F.max(F.when(is_low, F.col("_v"))).alias("_a"),
        F.max(F.when(~is_low, F.col("_v"))).alias("_b"),
        F.max("_frac").alias("_frac"),
    )
    step = F.coalesce(F.col("_b") - F.col("_a"), F.lit(0.0))
    return per_prob.select(*keys, "prob", (F.col("_a") + step * F.col("_frac")).alias("quantile"))


def describe_groups(df: DataFrame, keys: Sequence[str], value: str, few_values: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max per group; missing keys are left out.

    Set ``few_values`` for a column with a small domain (an age in years, a
    grade): the built-in percentile then does it all in one pass.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    stats = [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
    ]
    if few_values:
        quartiles = F.percentile(value, [0.25, 0.5, 0.75]).alias("_q")
        out = df.groupBy(*keys).agg(*stats, quartiles, F.max(value).alias("max"))
        parts = [F.col("_q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    else:
        long = exact_quantiles(df, keys, value, [0.25, 0.5, 0.75])
        wide = long.groupBy(*keys).agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
            ]
        )
        out = df.groupBy(*keys).agg(*stats, F.max(value).alias("max")).join(wide, list(keys), "left")
        parts = [F.col(n) for n in ("q25", "q50", "q75")]
    return out.select(*keys, "count", "mean", "std", "min", *parts, "max")


def distribution_summary(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """mean, its gap to a constant, median, population deviation, percent above."""
    above = F.avg((F.col(value) > threshold).cast("int")) * 100
    stats = df.agg(
        F.avg(value).alias("mean"),
        (F.avg(value) - threshold).alias("gap"),
        F.stddev_pop(value).alias("std"),
        above.alias("percent_above"),
    )
    median = exact_quantiles(df, [], value, [0.5]).select("quantile").scalar()
    return stats.select("mean", "gap", median.alias("median"), "std", "percent_above")


def first_percentile_above(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Smallest whole percentile 1 to 100 whose interpolated value is above a threshold.

    Four aggregates decide it without sorting: with ``k`` values up to the
    threshold, every rank from ``k`` on lies above it, and between the ranks
    ``k - 1`` and ``k`` only their two values matter.
    """
    v = F.col(value)
    facts = df.where(v.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v <= threshold).alias("k"),
        F.max(F.when(v <= threshold, v)).alias("below"),
        F.min(F.when(v > threshold, v)).alias("above"),
    )
    p = facts.where("n > 0").withColumn("percentile", F.explode(F.sequence(F.lit(1), F.lit(100))))
    steps = (F.col("n") - 1) * F.col("percentile")
    low = F.floor(steps / 100)
    frac = (steps % 100) / 100
    between = F.col("below") + (F.col("above") - F.col("below")) * frac
    is_above = (low >= F.col("k")) | (
        (low == F.col("k") - 1) & (frac > 0) & (between > threshold)
    )
    return p.where(is_above).agg(F.min("percentile").alias("percentile"))

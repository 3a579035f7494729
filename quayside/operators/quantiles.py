"""Exact statistics of groups of any size: no task holds the values of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path
from quayside.sources.sinks import materialize

_ALL, _V, _N, _PART = "_all", "_v", "_n", "_part"


def value_counts_by(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """How often each value of `c` occurs per group, missing ones included; rows with a missing key are left out."""
    rows = df.dropna(subset=list(keys)) if keys else df
    rows = rows.select(F.lit(0).alias(_ALL), *keys, F.col(c).cast("double").alias(_V))
    return rows.groupBy(_ALL, *keys, _V).agg(F.count(F.lit(1)).alias(_N))


def order_statistics(counts: DataFrame, keys: Sequence[str], quantiles: dict[str, float], folder: str) -> DataFrame:
    """One row per group of `counts` (see `value_counts_by`) with its interpolated quantiles.

    Values are dealt by ranges of (group, value). Rows are counted per range and group and summed up over
    the ranges, which tells where each wanted order statistic lies: two per quantile. Only ranges that
    hold one are read again and numbered, so a task holds one range, however large the group. Equal to
    `percentile`: position q * (n - 1), linear between neighbours.
    """
    group = [_ALL, *keys]
    present = counts.filter(F.col(_V).isNotNull())
    ranges = present.repartitionByRange(*group, _V).withColumn(_PART, F.spark_partition_id())
    dealt = materialize(ranges, f"{folder}/ranges")
    per = dealt.groupBy(*group, _PART).agg(F.sum(_N).alias("_held"))
    # A row per range and group.
    before = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({
        "_before": F.coalesce(F.sum("_held").over(before), F.lit(0)),
        "_total": F.sum("_held").over(Window.partitionBy(*group)),
    })
    at = {name: (F.col("_total") - 1) * F.lit(float(q)) for name, q in quantiles.items()}
    sought = F.array(*[f(p).cast("bigint") for p in at.values() for f in (F.floor, F.ceil)])

    def inside(start: Column, end: Column) -> Column:
        return F.exists(sought, lambda p: (p >= start) & (p < end))

    held = per.filter(inside(F.col("_before"), F.col("_before") + F.col("_held"))).drop("_held")
    # A range is shared out by its groups, of which the ends of two at most lie in other ranges.
    found = dealt.join(held, [*group, _PART])
    so_far = Window.partitionBy(*group, _PART).orderBy(_V).rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_to", F.col("_before") + F.sum(_N).over(so_far))
    found = found.withColumn("_from", F.col("_to") - F.col(_N)).filter(inside(F.col("_from"), F.col("_to")))

    def value_at(position: Column) -> Column:
        p = position.cast("bigint")
        return F.max(F.when((p >= F.col("_from")) & (p < F.col("_to")), F.col(_V)))

    ends = [
        value_at(f(p)).alias(f"_{k}{i}") for i, p in enumerate(at.values()) for k, f in (("low", F.floor), ("high", F.ceil))
    ]
    picked = found.groupBy(*group).agg(F.first("_total").alias("_total"), *ends)
    points = []
    for i, (name, p) in enumerate(at.items()):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        mixed = (F.ceil(p) - p) * low + (p - F.floor(p)) * high
        points.append(F.when(low == high, low).otherwise(mixed).alias(name))
    return picked.select(*group, *points)


def describe_spread(
    df: DataFrame, keys: Sequence[str], c: str, quantiles: dict[str, float], total: str | None = None, folder: str | None = None
) -> DataFrame:
    """As `aggregates.describe`, exact, for groups whose distinct values do not fit one task.

    Equal values are counted first and written to `folder` (a scratch folder if none is given); mean,
    deviation and quantiles come from these counts, so `df` is computed once.
    """
    folder = folder or scratch_path(df.sparkSession, "describe")
    group = [_ALL, *keys]
    counts = materialize(value_counts_by(df, keys, c), f"{folder}/counts")
    n = F.when(F.col(_V).isNotNull(), F.col(_N))
    sums = counts.groupBy(*group).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.sum(F.col(_V) * n).alias("_sum"), F.min(_V).alias("min"), F.max(_V).alias("max")
    )
    sums = sums.withColumn("mean", F.try_divide("_sum", "n"))
    # Squares of differences from the mean do not lose digits far from zero. Counts are many per group, groups few.
    apart = counts.join(sums.select(*group, "mean"), group).groupBy(*group).agg(
        F.sum(n * (F.col(_V) - F.col("mean")) * (F.col(_V) - F.col("mean"))).alias("_apart")
    )
    points = order_statistics(counts, keys, quantiles, folder)
    out = sums.join(apart, group).join(points, group, "left")
    std = F.sqrt(F.try_divide("_apart", F.col("n") - 1))
    return out.select(
        *keys, "n", "mean", F.when(F.col("n") > 1, std).alias("std"), "min", *quantiles, "max", *([F.col("_sum").alias(total)] if total else [])
    )

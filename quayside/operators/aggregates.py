"""Aggregation operators. All have map-side partial forms in Spark."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.numeric import ratio
from quayside.functions.text import as_col

DECILES = tuple(i / 10 for i in range(1, 11))
QUARTILES = (0.25, 0.5, 0.75)


def group_agg(
    df: DataFrame, keys: Sequence[str], *measures: Column, drop_null_keys: bool = True
) -> DataFrame:
    """Grouped aggregate in which rows with a missing key take no part."""
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(*measures)


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    return group_agg(df, [c], F.count(F.lit(1)).alias(name))


def present_counts(columns: dict[str, str]) -> list[Column]:
    """Non-missing counts, output name -> input column."""
    return [F.count(F.col(c)).alias(name) for name, c in columns.items()]


def conditional_counts(conditions: dict[str, Column]) -> list[Column]:
    return [F.count_if(cond).alias(name) for name, cond in conditions.items()]


def missing_share(c: Column | str) -> Column:
    """Share of a group's rows in which a measure is missing."""
    return F.count_if(as_col(c).isNull()) / F.count(F.lit(1))


def in_full(counted: Column | str, ordered: Column | str) -> Column:
    return F.abs(ratio(counted, ordered))


def scale_by_first(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Divide every listed measure by the first of them, row by row."""
    base = F.col(columns[0])
    return df.withColumns({c: ratio(F.col(c), base) for c in columns})


def describe(
    df: DataFrame,
    keys: Sequence[str],
    c: str,
    quantiles: dict[str, float],
    total: str | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, interpolated quantiles, maximum.

    With `total`, the sum as well. Mean and deviation combine task by task without loss far
    from zero. Equal values are counted before the shuffle, so the exact quantiles of
    a group cost its distinct values, however many rows share them. Where even those are too
    many for one task (free doubles), `accuracy` asks for approximate quantiles instead.
    """
    if keys:
        df = df.dropna(subset=list(keys))
    at = list(quantiles.values())
    value = F.col(c).cast("double")
    points = F.percentile(F.col(c), at) if accuracy is None else F.percentile_approx(F.col(c), at, accuracy)
    sums = df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("_mean"),
        F.stddev_samp(value).alias("_std"),
        F.sum(value).alias("_sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        points.alias("_points"),
    )
    named = [F.get("_points", F.lit(i)).alias(name) for i, name in enumerate(quantiles)]
    return sums.select(
        *keys,
        "n",
        F.col("_mean").alias("mean"),
        F.col("_std").alias("std"),
        "min",
        *named,
        "max",
        *([F.col("_sum").alias(total)] if total else []),
    )


def unstack(
    df: DataFrame, keys: Sequence[str], pivot: str, values: Sequence[Any], measure: Column
) -> DataFrame:
    """Spread one key over columns; the values are given, so no extra job runs."""
    return group_agg(df, [*keys, pivot], measure.alias("_m")).groupBy(*keys).pivot(
        pivot, list(values)
    ).agg(F.first("_m"))


def margins_pivot(
    df: DataFrame,
    row: str,
    column: str,
    values: Sequence[str],
    amount: str,
    total: str = "All",
) -> DataFrame:
    """Two-way table of sums of `amount`, with totals for rows, columns and both.

    Sums per cell come first, so that only cells are expanded into totals. Totals are told
    apart by the grouping, not by their label: a row named like `total` stays beside the
    total row. A column of that name could not be told from the total and is an error.
    """
    if total in values:
        raise ValueError(f"{total!r} names both a column and the total")
    cells = (
        group_agg(df, [row, column], F.sum(amount).alias("_cell"))
        .cube(row, column)
        .agg(F.sum("_cell").alias("_m"), F.grouping(row).alias("_gr"), F.grouping(column).alias("_gc"))
        .select(
            "_gr",
            F.when(F.col("_gr") == 1, F.lit(total)).otherwise(F.col(row)).alias(row),
            F.when(F.col("_gc") == 1, F.lit("t")).otherwise(F.concat(F.lit("c"), column)).alias("_column"),
            "_m",
        )
    )
    wide = cells.groupBy("_gr", row).pivot("_column", [*(f"c{v}" for v in values), "t"]).agg(F.first("_m"))
    return wide.select(row, *(F.col(f"`c{v}`").alias(v) for v in values), F.col("t").alias(total))


def waterfall(
    df: DataFrame,
    keys: Sequence[str],
    amount: Column,
    stages: dict[str, Column],
    missing_as_zero: bool = False,
) -> DataFrame:
    """Conditional sums of nested stages, each less all earlier ones, in one pass.

    A stage without rows is NULL and makes the later ones NULL, unless `missing_as_zero` counts
    it as 0. Groups that no stage touches are absent.
    """
    raw = {name: F.sum(F.when(cond, amount)) for name, cond in stages.items()}
    if missing_as_zero:
        raw = {name: F.coalesce(total, F.lit(0)) for name, total in raw.items()}
    raw = {name: total.alias(f"_s_{name}") for name, total in raw.items()}
    touched = F.lit(False)
    for cond in stages.values():
        touched = touched | F.coalesce(cond, F.lit(False))
    grouped = group_agg(df.filter(touched), keys, *raw.values())
    steps: list[Column] = []
    previous: str | None = None
    # Subtracting all earlier steps equals subtracting the previous cumulative sum,
    # provided every earlier sum exists.
    so_far = F.lit(True)
    for name in stages:
        current = F.col(f"_s_{name}")
        step = current if previous is None else current - F.col(previous)
        steps.append(F.when(so_far, step).alias(name))
        so_far = so_far & current.isNotNull()
        previous = f"_s_{name}"
    return grouped.select(*keys, *steps)

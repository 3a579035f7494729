"""Unions and rolling state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def roll_history(
    history: DataFrame, new: DataFrame, as_of: date, days: int, on: str = "date"
) -> DataFrame:
    """History plus new rows, no older than `days` before `as_of`, with their age.

    `age` counts days from the start of the retained period. The date filter reaches
    both scans, so a history partitioned by date is pruned.
    """
    start = as_of - timedelta(days=days)
    kept = stack([history, new]).filter(F.col(on) >= F.lit(start))
    return kept.withColumn("age", F.datediff(F.col(on), F.lit(start)))


def consolidate(frames: Sequence[DataFrame], required: str) -> DataFrame:
    """Distinct rows of all frames; rows without the required value are dropped."""
    return stack(frames).dropna(subset=[required]).distinct()

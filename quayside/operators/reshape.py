"""One-to-many reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_pieces(df: DataFrame, c: str, pieces: Column, position: str = "piece") -> DataFrame:
    """One row per piece, replacing `c`; a missing list keeps its row, empty pieces stay."""
    others = [name for name in df.columns if name != c]
    return df.select(*others, F.posexplode_outer(pieces).alias(position, c))


def columns_to_rows(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)


def stage_pairs(
    history: DataFrame, key: str, stages: Sequence[str], name: str = "stage", value: str = "time"
) -> DataFrame:
    """Distinct, complete (key, stage, value) triples of a wide history, in one pass."""
    return columns_to_rows(history, [key], stages, name, value).dropna().distinct()

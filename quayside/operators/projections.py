"""Projection operators."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import as_col, blank_to_null


def project(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Select, rename and reorder in one step: output name -> input column."""
    return df.select(*[as_col(c).alias(name) for name, c in mapping.items()])


def stamp(df: DataFrame, **values: Any) -> DataFrame:
    """Add constant columns such as the as-of date, shift or team."""
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Turn empty text into NULL in every text column."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: blank_to_null(c) for c in text})


def item_key(barcode: Column | str, ean: Column | str, sku: Column | str) -> Column:
    """Barcode if there is one, else EAN, else the SKU."""
    return F.coalesce(blank_to_null(barcode), blank_to_null(ean), as_col(sku))


def fill_key(primary: Column | str, fallback: Column | str) -> Column:
    return F.coalesce(as_col(primary), as_col(fallback))


def overwrite_where(c: Column | str, condition: Column, value: Column | Any) -> Column:
    """Masked assignment: a NULL condition leaves the old value in place."""
    new = value if isinstance(value, Column) else F.lit(value)
    return F.when(condition, new).otherwise(as_col(c))


def indicator(c: Column | str) -> Column:
    """1 where a value is present, else NULL, so that a sum counts rows."""
    return F.when(as_col(c).isNotNull(), F.lit(1))

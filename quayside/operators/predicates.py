"""Filters whose NULL behaviour is spelled out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import month_index
from quayside.functions.text import as_col, holds

# Case-sensitive patterns on the reference text of a PO.
NOT_FOR_SALE = "sample|Sample|SAMPLE|samples|Samples|OS|Os|OVERSUPPLY|fraud"
NOT_FOR_SALE_OR_REJECTED = NOT_FOR_SALE + "|not OK"
OVERSUPPLY = "OS|Os|OVERSUPPLY"

CANCELLED = "Cancel PO"
DRAFT = "Draft PO"
DELETED = "Deleted"


def matches(c: Column | str, pattern: str) -> Column:
    """Regex search that is false, not NULL, for missing text."""
    return F.coalesce(as_col(c).rlike(pattern), F.lit(False))


def exclude_matching(df: DataFrame, c: Column | str, pattern: str) -> DataFrame:
    """Drop rows whose text matches; rows without text stay."""
    col = as_col(c)
    return df.filter(col.isNull() | ~col.rlike(pattern))


def include_matching(df: DataFrame, c: Column | str, pattern: str) -> DataFrame:
    return df.filter(matches(c, pattern))


def differs(c: Column | str, value: Any) -> Column:
    """`!=` under which a missing value differs from any given one."""
    return ~as_col(c).eqNullSafe(F.lit(value))


def outside(c: Column | str, values: Sequence[Any]) -> Column:
    """Negated membership under which a missing value is outside."""
    return ~F.coalesce(as_col(c).isin(*values), F.lit(False))


def not_cancelled(status: Column | str) -> Column:
    """Missing status fails as well."""
    c = as_col(status)
    return c.isNotNull() & ~holds(c, CANCELLED)


def placed(status: Column | str) -> Column:
    """Status present and not a draft."""
    c = as_col(status)
    return c.isNotNull() & (c != DRAFT)


def drop_missing(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    how: str = "any",
    min_present: int | None = None,
) -> DataFrame:
    return df.dropna(how=how, thresh=min_present, subset=list(subset) if subset else None)


def month_window(
    df: DataFrame, year: Column | str, month: Column | str, as_of: date, back: int, fwd: int
) -> DataFrame:
    """Months from `back` before to `fwd` after the month of `as_of`, across year ends."""
    centre = as_of.year * 12 + as_of.month
    return df.filter(month_index(year, month).between(centre - back, centre + fwd))


def shorter_than(c: Column | str, length: int) -> Column:
    return F.length(as_col(c)) < length

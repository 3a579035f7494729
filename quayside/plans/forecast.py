"""Planned and received units by delivery week."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import iso_week_day, shift_days, shift_month, year_month
from quayside.operators.aggregates import group_agg, margins_pivot
from quayside.operators.predicates import (
    DELETED,
    NOT_FOR_SALE,
    differs,
    exclude_matching,
    month_window,
)

# Fixed value: days before go-live by which goods are due when a PO names no date.
DAYS_BEFORE_GO_LIVE = 14


def delivery_weeks(inbound: DataFrame, as_of: date, back: int = 2, fwd: int = 2) -> DataFrame:
    """Saleable rows by the Wednesday of their due week, inside the month window."""
    rows = exclude_matching(inbound, "ref", NOT_FOR_SALE)
    due = F.coalesce("delivery_due", shift_days("gl_date", -DAYS_BEFORE_GO_LIVE))
    rows = rows.withColumn("delivery_week", iso_week_day(due))
    rows = rows.filter(differs("procurement_status", DELETED))
    return month_window(rows, *year_month("delivery_week"), as_of, back, fwd)


def weeks_in_window(as_of: date, back: int = 2, fwd: int = 2) -> list[date]:
    """Every Wednesday of the months in the window: the columns of the unit plan."""
    first = date(*shift_month(as_of, -back), 1)
    end = date(*shift_month(as_of, fwd + 1), 1)
    day = first + timedelta(days=(2 - first.weekday()) % 7)
    weeks = []
    while day < end:
        weeks.append(day)
        day += timedelta(days=7)
    return weeks


def weekly_forecast(weeks: DataFrame) -> DataFrame:
    return group_agg(
        weeks,
        ["delivery_week"],
        F.sum("total_units").alias("qty_planned"),
        F.sum("qty_received").alias("qty_received"),
    )


def unit_plan(weeks: DataFrame, as_of: date, back: int = 2, fwd: int = 2) -> DataFrame:
    """Planned units, category by week, with totals. Weeks without rows stay empty."""
    text = weeks.withColumn("week", F.date_format("delivery_week", "yyyy-MM-dd"))
    names = [w.isoformat() for w in weeks_in_window(as_of, back, fwd)]
    return margins_pivot(text, "category", "week", names, "total_units")

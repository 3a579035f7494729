"""Supplier and buyer compliance with bookings and due dates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import days_apart, shift_month
from quayside.operators.aggregates import group_agg, in_full, missing_share
from quayside.operators.predicates import NOT_FOR_SALE, differs, exclude_matching, placed
from quayside.operators.sorting import sort_keys

MEANS = ("missed_booking_days", "missed_plan_days")
SUMS = ("total_units", "total_cost", "qty_counted", "qty_damaged")


def compliance_lines(inbound: DataFrame) -> DataFrame:
    """Placed orders of saleable goods with their day differences."""
    rows = exclude_matching(inbound, "ref", NOT_FOR_SALE)
    rows = rows.filter(placed("status") & differs("total_units", 0))
    return rows.withColumns(
        {
            "missed_booking_days": days_apart("date_received", "date_booked"),
            "missed_plan_days": days_apart("delivery_due", "date_received"),
        }
    )


def compliance(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per PO first, then per key: sums, means of PO means, shares without a date."""
    per_po = group_agg(
        lines,
        [*keys, "pos"],
        *[F.sum(c).alias(c) for c in SUMS],
        *[F.avg(c).alias(c) for c in MEANS],
    )
    return group_agg(per_po, keys, *_measures())


def _measures() -> list[Column]:
    return [
        F.sum("total_cost").alias("total_cost"),
        F.count(F.lit(1)).alias("pos"),
        F.sum("total_units").alias("total_units"),
        F.avg("missed_booking_days").alias("missed_booking_days"),
        missing_share("missed_booking_days").alias("not_booked"),
        F.avg("missed_plan_days").alias("missed_plan_days"),
        missing_share("missed_plan_days").alias("not_delivered"),
        in_full(F.sum("qty_counted"), F.sum("total_units")).alias("in_full"),
        F.sum("qty_damaged").alias("qty_damaged"),
    ]


def compliance_order(keys: Sequence[str]) -> list[Column]:
    leading = [k for k in keys if k == "gl_month"]
    order = [*leading, "not_booked", "not_delivered", "in_full", "total_cost"]
    return sort_keys(order, descending=("not_booked", "not_delivered", "total_cost"), nulls="first")


# The tabs of both reports and their keys.
TABS = {"supplier": ("gl_month", "supplier"), "buyer": ("gl_month", "buyer"), "buyer_period": ("buyer",)}


def compliance_tabs(inbound: DataFrame) -> DataFrame:
    """Suppliers by month, buyers by month and buyers over the whole period, told apart by `tab`, from one pass.

    POs are aggregated under the keys of all tabs at once, by grouping sets, and shuffled once; a second, small
    aggregate makes the tabs. Keys that a tab does not have are missing.
    """
    every = ("gl_month", "supplier", "buyer", "pos")
    lines = compliance_lines(inbound).filter(F.col("pos").isNotNull())
    sets = [[*keys, "pos"] for keys in TABS.values()]
    per_po = lines.groupingSets(sets, *every).agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.avg(c).alias(c) for c in MEANS], F.grouping_id().alias("_set")
    )
    tab = present = None
    for name, keys in TABS.items():
        number = sum(1 << i for i, c in enumerate(reversed(every)) if c not in (*keys, "pos"))
        here = F.col("_set") == number
        tab = F.when(here, name) if tab is None else tab.when(here, name)
        held = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        present = F.when(here, held) if present is None else present.when(here, held)
    per_po = per_po.withColumn("tab", tab).filter(present)
    return per_po.groupBy("tab", *every[:-1]).agg(*_measures())


def supplier_compliance(inbound: DataFrame) -> DataFrame:
    return compliance(compliance_lines(inbound), ["gl_month", "supplier"])


def buyer_compliance(inbound: DataFrame) -> DataFrame:
    return compliance(compliance_lines(inbound), ["gl_month", "buyer"])


def buyer_compliance_period(inbound: DataFrame) -> DataFrame:
    return compliance(compliance_lines(inbound), ["buyer"])


def last_month_number(as_of: date) -> int:
    return shift_month(as_of, -1)[1]


def last_month(monthly: DataFrame, as_of: date) -> DataFrame:
    """The slice of the month before `as_of`."""
    return monthly.filter(F.col("gl_month") == last_month_number(as_of))

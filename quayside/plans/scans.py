"""Shift stock counts, daily damages and oversupply, and their rolling states."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import as_col, as_key, blank_to_null, fold_code
from quayside.operators.aggregates import group_agg
from quayside.operators.dedupe import keep_last
from quayside.operators.joins import (
    fan_out_join,
    full_join_few,
    left_join,
    outer_join_filled,
    skew_join,
)
from quayside.operators.projections import stamp
from quayside.operators.setops import consolidate
from quayside.operators.sorting import sort_keys
from quayside.sources.tables import read_history_dir

# Team letter -> history the count belongs to.
SAMPLES_TEAM = "S"


def count_history(team: str) -> str:
    """Name of the rolling table a team's counts go to."""
    return "samples_returned" if team == SAMPLES_TEAM else "rolling_stock"


def scan_counts(scans: DataFrame, code: str, name: str, *extra: str) -> DataFrame:
    """Number of scans per code; codes are folded before counting."""
    folded = scans.withColumn(code, fold_code(code))
    return group_agg(folded, [code, *extra], F.count(F.lit(1)).alias(name))


def plan_categories(plan: DataFrame) -> DataFrame:
    return plan.select(F.col("simple_sku").alias("product_id"), "category").distinct()


def counted_less_ordered(counted: Column | str, ordered: Column | str) -> Column:
    return as_col(counted) - as_col(ordered)


def shift_count(
    scans: DataFrame, po_lines: DataFrame, plan: DataFrame, shift: date, team: str
) -> DataFrame:
    """Scanned quantity of a shift against every PO line of the item, with its category."""
    counted = stamp(scan_counts(scans, "product_id", "qty_counted"), date=shift, team=team)
    lines = po_lines.withColumnRenamed("sku", "product_id")
    described = left_join(counted, plan_categories(plan), "product_id")
    rows = fan_out_join(described, lines, "product_id")
    report = rows.select(
        "date",
        F.col("pos").alias("po"),
        "status",
        "ref",
        F.col("contact").alias("supplier"),
        F.col("bp_qty").alias("qty_ordered"),
        "qty_counted",
        counted_less_ordered("qty_counted", "bp_qty").alias("qty_diff"),
        "product_id",
        F.col("name").alias("description"),
        "category",
        "team",
    )
    return report.distinct()


def shift_order() -> list[Column]:
    return sort_keys(["supplier", "product_id", "po"])


def rolling_stock(
    spark: SparkSession, history_dir: str, schema: str | None = None, skip_unreadable: bool = False
) -> DataFrame:
    """All shift files of a directory as one table of distinct rows with a product."""
    return consolidate([read_history_dir(spark, history_dir, schema, skip_unreadable)], "product_id")


def last_contacts(contacts: DataFrame) -> DataFrame:
    """Latest contact per PO; rows with an empty PO would match nothing and are dropped."""
    known = contacts.filter(blank_to_null("pos").isNotNull())
    last = keep_last(known, ["pos"], ["date", "seq", "piece"])
    return last.select(F.col("pos").alias("po"), "client_name", "client_email")


def _line_details(po_lines: DataFrame) -> DataFrame:
    return po_lines.select(
        as_key("pos").alias("po"),
        "sku",
        F.col("contact").alias("supplier"),
        F.col("name").alias("description"),
    )


def daily_damages(
    damages: DataFrame,
    oversupply: DataFrame,
    po_lines: DataFrame,
    contacts: DataFrame,
    as_of: date,
) -> DataFrame:
    """Damaged and oversupplied items with every PO line of the item and its contact."""
    damaged = scan_counts(damages, "product_id", "damaged", "reason")
    surplus = scan_counts(oversupply, "sku", "oversupply")
    items = outer_join_filled(damaged, surplus, "product_id", "sku", "sku")
    placed = fan_out_join(items, _line_details(po_lines), "sku")
    rows = skew_join(placed, last_contacts(contacts), "po", "left")
    report = stamp(rows, date=as_of).select(
        "date",
        "supplier",
        "po",
        "sku",
        "description",
        "reason",
        "damaged",
        "oversupply",
        "client_name",
        "client_email",
    )
    return report


def daily_order() -> list[Column]:
    return sort_keys(["supplier", "po", "sku"])


def rolling_damages(damages: DataFrame, po_lines: DataFrame) -> DataFrame:
    """Every damage scan with every PO line of its item."""
    scans = damages.select(
        F.col("scan_date").alias("date"),
        fold_code("product_id").alias("sku"),
        "reason",
        "responsible",
    )
    lines = po_lines.select(as_key("pos").alias("pos"), "sku")
    return fan_out_join(scans, lines, "sku").select("date", "pos", "sku", "reason", "responsible")


def rolling_oversupply(
    damages: DataFrame, oversupply: DataFrame, po_lines: DataFrame, as_of: date
) -> DataFrame:
    """The oversupplied rows of the daily report: an item's count with every PO line, once per damage reason.

    Only items that were oversupplied are looked at, and no contacts.
    """
    surplus = scan_counts(oversupply, "sku", "oversupply")
    reasons = scan_counts(damages, "product_id", "damaged", "reason").select(F.col("product_id").alias("sku"), F.lit(1).alias("_r"))
    items = left_join(surplus, reasons, "sku").drop("_r")
    placed = fan_out_join(items, _line_details(po_lines).drop("description"), "sku")
    return stamp(placed, date=as_of).select("date", "supplier", "po", "sku", "oversupply")


def bad_stock(
    inventory: DataFrame,
    oversupply: DataFrame,
    po_items: DataFrame,
    contacts: DataFrame,
    as_of: date,
) -> DataFrame:
    """Warehouse bad stock of the day and oversupply, with PO items and contact."""
    today = inventory.filter(F.col("inv_date") == F.lit(as_of)).select(
        "brand_name", "simple_sku", "qc_bad_qty"
    )
    surplus = scan_counts(oversupply, "sku", "oversupply").withColumnRenamed("sku", "simple_sku")
    items = full_join_few(today, surplus, "simple_sku")
    details = po_items.select(
        F.col("purchase_order_number").alias("po"),
        "simple_sku",
        F.col("simple_name").alias("description"),
        F.col("supplier_name").alias("supplier"),
    )
    placed = fan_out_join(items, details, "simple_sku")
    rows = skew_join(placed, last_contacts(contacts), "po", "left")
    report = stamp(rows, date=as_of).select(
        "date",
        "supplier",
        "po",
        "simple_sku",
        "description",
        "brand_name",
        F.col("qc_bad_qty").alias("damaged"),
        "oversupply",
        "client_name",
        "client_email",
    )
    return report

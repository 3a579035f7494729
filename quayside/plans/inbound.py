"""The wide inbound table: planned items against PO lines, dock, counts and stock.

Shape of the plan. Every source is aggregated to its join key before any join:

* per PO: due dates, first booking, last receipt;
* per (item, PO): quality-control counts and warehouse receipts, in one aggregate;
* per item: damages and stock in one aggregate, and the first saleable PO line.

Item-keyed sources are first reduced to the items planned in the window, by semi joins that Spark turns
into broadcasts where the keys are few and that a hot key can split where they are not. PO-keyed sources are
not reduced to the POs of the remaining lines: these come from a shuffle, so header and dock log would be
shuffled row by row before they are aggregated, and the lines once more for their POs.

PO-keyed and (item, PO)-keyed facts are attached to PO lines before the lines meet the
plan. A line always has a PO, so planned items without one never travel through a join
on a missing key. The two joins whose key may be very uneven (PO, item) can be split
at run time.

The measures of a planned item belong on one row per item. Which row that is can be
decided on each side alone: the earliest planned row of the item, and its smallest
saleable line. So no window runs over the joined table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.calendar import parse_timestamp
from quayside.functions.text import HEADER_PO_STRIP, as_key, blank_to_null, strip_chars
from quayside.operators.aggregates import group_agg
from quayside.operators.dedupe import keep_last, nulls_last
from quayside.operators.joins import fan_out_join, left_join, skew_join
from quayside.operators.predicates import (
    DELETED,
    DRAFT,
    NOT_FOR_SALE,
    OVERSUPPLY,
    matches,
    month_window,
    not_cancelled,
    shorter_than,
)
from quayside.operators.projections import item_key
from quayside.operators.setops import stack

DOCK_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")

# A warehouse message whose reference is shorter than this carries a PO number.
PO_REFERENCE_LENGTH = 7

# Row classes: the row that carries its item's measures, other rows, blanked rows.
FIRST, REPEAT, BLANKED = 0, 1, 2


def frame_order() -> list[Column | str]:
    """Arrival order of the inbound table: a total order over its rows."""
    return [
        "row_class",
        "seq",
        nulls_last("pos"),
        "ref",
        "status",
        nulls_last("delivery_due"),
    ]


@dataclass(frozen=True)
class InboundSources:
    """Input tables of the inbound plan."""

    plan: DataFrame
    po_lines: DataFrame
    po_header: DataFrame
    dock_log: DataFrame
    qc: DataFrame
    damages: DataFrame
    received: DataFrame
    stock: DataFrame


def only_known(rows: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key is among `keys`; all rows where no keys are given."""
    return rows if keys is None else skew_join(rows, keys, key, "left_semi")


def po_line_groups(po_lines: DataFrame, skus: DataFrame | None = None) -> DataFrame:
    """Ordered quantity per (item, PO, reference, status); lines missing any are lost."""
    lines = only_known(po_lines.filter(not_cancelled("status")), skus, "sku")
    return group_agg(lines, ["sku", "pos", "ref", "status"], F.sum("bp_qty").alias("bp_qty"))


def cancelled_orders(po_lines: DataFrame) -> DataFrame:
    """Number of item lines per cancelled PO."""
    cancelled = po_lines.filter(F.col("status") == "Cancel PO")
    return group_agg(cancelled, ["pos"], F.count("sku").alias("n_skus"))


def header_dates(po_header: DataFrame) -> DataFrame:
    """Distinct due dates per PO; rows without a PO are dropped."""
    number = strip_chars("order_id_raw", HEADER_PO_STRIP).alias("pos")
    return po_header.select(number, "delivery_due").filter(F.col("pos").isNotNull()).distinct()


def dock_events(dock_log: DataFrame) -> DataFrame:
    """First booking and last receipt per PO, in one pass; blank POs are dropped."""
    booked, received = blank_to_null("date_booked"), blank_to_null("date_received")
    log = dock_log.filter(blank_to_null("pos").isNotNull())
    return log.groupBy("pos").agg(
        F.to_date(
            parse_timestamp(
                F.min_by(booked, F.when(booked.isNotNull(), F.col("seq"))), DOCK_DATE_FORMATS
            )
        ).alias("date_booked"),
        F.max_by("partial_delivery", F.when(received.isNotNull(), F.col("seq"))).alias(
            "partial_delivery"
        ),
        F.to_date(
            parse_timestamp(
                F.max_by(received, F.when(received.isNotNull(), F.col("seq"))), DOCK_DATE_FORMATS
            )
        ).alias("date_received"),
    )


def po_facts(po_header: DataFrame, dock_log: DataFrame) -> DataFrame:
    """Everything keyed by PO. A PO with several due dates has a row for each."""
    due = header_dates(po_header)
    # After the distinct, a PO has at most one row per calendar day.
    by_po = Window.partitionBy("pos").orderBy(F.col("delivery_due").asc_nulls_last())
    due = due.withColumn("due_rank", F.row_number().over(by_po))
    return due.join(dock_events(dock_log), "pos", "full")


def item_po_facts(
    qc: DataFrame, received: DataFrame, skus: DataFrame | None = None
) -> DataFrame:
    """Quality-control counts and warehouse receipts per (item, PO)."""
    counted = qc.select(
        as_key("sku").alias("sku"), as_key("pos").alias("pos"), "qty_counted", "qc_date"
    )
    taken_in = received.filter(shorter_than("message_reference", PO_REFERENCE_LENGTH)).select(
        F.col("item_code").alias("sku"),
        F.col("message_reference").alias("pos"),
        "quantity_received",
        "received_date",
    )
    return group_agg(
        only_known(stack([counted, taken_in]), skus, "sku"),
        ["sku", "pos"],
        F.sum("qty_counted").alias("qty_counted"),
        F.max("qc_date").alias("last_qced"),
        F.sum("quantity_received").alias("qty_received"),
        F.max("received_date").alias("last_received"),
    )


def _line_position() -> Column:
    return F.struct("pos", "ref", "status")


def item_facts(
    damages: DataFrame, stock: DataFrame, skus: DataFrame | None = None
) -> DataFrame:
    """Damaged and stored units per item."""
    damaged = damages.select(as_key("sku").alias("sku"), F.lit(1).alias("damaged"))
    stored = stock.select(F.col("item_code").alias("sku"), "qty")
    return group_agg(
        only_known(stack([damaged, stored]), skus, "sku"),
        ["sku"],
        F.sum("damaged").alias("qty_damaged"),
        F.sum("qty").alias("qty_putaway"),
    )


def item_lines(groups: DataFrame, blank: str) -> DataFrame:
    """Per item with PO lines: the first saleable one, if any.

    The mark is taken from the quantity, although any column would do: with the same
    columns as the other use of the groups, Spark computes and shuffles them once.
    """
    saleable = F.when(~matches("ref", blank), _line_position())
    return groups.groupBy("sku").agg(
        F.min(saleable).alias("first_line"),
        F.max(F.coalesce("bp_qty", F.lit(0))).isNotNull().alias("has_lines"),
    )


def _in_window(plan: DataFrame, as_of: date, back: int, fwd: int) -> DataFrame:
    window = month_window(plan, "gl_year", "gl_month", as_of, back, fwd)
    return window.filter(F.col("total_cost") > 0)


def planned_skus(plan: DataFrame, as_of: date, back: int, fwd: int) -> DataFrame:
    """Items with any row that `planned_items` may keep, by filters of the scan alone."""
    rows = _in_window(plan, as_of, back, fwd)
    return rows.select(item_key("barcode", "ean", "simple_sku").alias("sku")).distinct()


def planned_items(plan: DataFrame, as_of: date, back: int, fwd: int) -> DataFrame:
    """Planned rows in the month window, last per (item, month), with a positive cost.

    The window comes after the choice of the last row: the key has no year, so a row of
    another year may displace one inside the window.
    """
    keyed = plan.withColumn("sku", item_key("barcode", "ean", "simple_sku"))
    return _in_window(keep_last(keyed, ["sku", "gl_month"], ["seq"]), as_of, back, fwd)


def inbound_data(
    sources: InboundSources,
    as_of: date,
    back: int = 3,
    fwd: int = 1,
    blank: str = NOT_FOR_SALE,
    oversupply: str = OVERSUPPLY,
) -> DataFrame:
    """One row per planned row and PO line group of its item.

    `total_units`, `total_cost` and `qty_putaway` stand on the first row of an item
    only, so that they can be summed. `qty_damaged` repeats on every row of an item:
    a sum over it counts an item once per row.
    """
    skus = planned_skus(sources.plan, as_of, back, fwd)
    groups = po_line_groups(sources.po_lines, skus)
    # Line groups per (item, PO) differ by reference and status only.
    counted = left_join(groups, item_po_facts(sources.qc, sources.received, skus), ["sku", "pos"])
    orders = po_facts(sources.po_header, sources.dock_log)
    lines = skew_join(counted, orders, "pos", "left")

    plan = planned_items(sources.plan, as_of, back, fwd)
    plan = left_join(plan, item_facts(sources.damages, sources.stock, skus), "sku")
    plan = left_join(plan, item_lines(groups, blank), "sku")
    deleted = F.coalesce(F.col("procurement_status") == DELETED, F.lit(False))
    # The plan holds at most one row per item and month, so this window is small.
    by_item = Window.partitionBy("sku").orderBy("_deleted", "seq")
    plan = plan.withColumn("_deleted", deleted).withColumn(
        "_first_plan", (F.row_number().over(by_item) == 1) & ~F.col("_deleted")
    )

    wide = fan_out_join(plan, lines, "sku", present="has_lines")

    sample = matches("ref", blank)
    first_line = F.col("pos").isNull() | (
        (_line_position() == F.col("first_line")) & (F.coalesce("due_rank", F.lit(1)) == 1)
    )
    row_class = (
        F.when(sample | F.col("_deleted"), BLANKED)
        .when(F.col("_first_plan") & F.coalesce(first_line, F.lit(False)), FIRST)
        .otherwise(REPEAT)
    )
    wide = wide.withColumn("row_class", row_class).filter(
        (F.col("row_class") != REPEAT) | ~F.col("status").eqNullSafe(DRAFT)
    )
    is_first = F.col("row_class") == FIRST
    keeps_putaway = is_first | ((F.col("row_class") == BLANKED) & ~sample)
    table = wide.select(
        "seq",
        "row_class",
        "sku",
        "simple_sku",
        "simple_name",
        "config_sku",
        "config_name",
        "category",
        "buyer",
        "supplier",
        "designer",
        "procurement_status",
        "gl_day",
        "gl_date",
        "gl_month",
        "gl_year",
        "live_date",
        "unit_cost",
        F.when(is_first, F.col("total_units")).alias("total_units"),
        F.when(is_first, F.col("total_cost")).alias("total_cost"),
        "pos",
        "ref",
        "status",
        "bp_qty",
        "delivery_due",
        "date_booked",
        "partial_delivery",
        "date_received",
        "qty_counted",
        "last_qced",
        "qty_damaged",
        "qty_received",
        "last_received",
        F.when(keeps_putaway, F.col("qty_putaway")).alias("qty_putaway"),
        F.when(matches("ref", oversupply), F.col("bp_qty")).alias("oversupply"),
    )
    # Blank cells of the finished table are missing ones.
    texts = [f.name for f in table.schema.fields if f.dataType.simpleString() == "string"]
    return table.withColumns({c: blank_to_null(c) for c in texts})

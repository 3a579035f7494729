"""Visibility master, warehouse track and progress statistics, all from the inbound table.

The statistics on configs use every inbound row; those on units, POs and capital leave
out rows whose PO reference marks samples, oversupply, fraud or a rejected order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import iso_week_day
from quayside.operators.aggregates import (
    conditional_counts,
    group_agg,
    present_counts,
    scale_by_first,
    waterfall,
)
from quayside.operators.dedupe import (
    flag_repeats_bounded,
    keep_first,
    nulls_last,
    reduce_partial_deliveries,
)
from quayside.operators.joins import skew_join
from quayside.operators.predicates import DRAFT, NOT_FOR_SALE_OR_REJECTED, exclude_matching
from quayside.operators.projections import indicator
from quayside.operators.sorting import sort_keys
from quayside.plans.inbound import frame_order

MASTER_COLUMNS = (
    "gl_year",
    "gl_month",
    "gl_day",
    "buyer",
    "unit_cost",
    "total_units",
    "total_cost",
    "sku",
    "simple_name",
    "procurement_status",
    "category",
    "supplier",
    "delivery_due",
    "pos",
    "bp_qty",
    "ref",
    "status",
    "date_booked",
    "partial_delivery",
    "date_received",
    "last_qced",
    "qty_counted",
    "qty_damaged",
    "sample_count",
    "oversupply",
    "last_received",
    "qty_received",
    "qty_putaway",
    "live_date",
)

TRACK_COLUMNS = (
    "sku",
    "simple_name",
    "category",
    "supplier",
    "pos",
    "delivery_due",
    "date_booked",
    "date_received",
    "last_qced",
    "last_received",
    "unit_cost",
    "total_units",
    "total_cost",
    "bp_qty",
    "qty_counted",
    "qty_damaged",
    "qty_received",
    "qty_putaway",
    "partial_delivery",
    "buyer",
    "procurement_status",
    "status",
    "ref",
    "gl_month",
)

FUNNEL = {
    "planned": "config_sku",
    "on_bp": "pos",
    "booked": "date_booked",
    "received": "date_received",
    "qced": "last_qced",
    "live": "live_date",
}


def with_samples(inbound: DataFrame, samples: DataFrame, stage: str = "s3_to_studio") -> DataFrame:
    """Add a count of 1 where the item's sample reached the studio; several samples fan out."""
    known = samples.select("sku", indicator(stage).alias("sample_count"))
    return skew_join(inbound, known, "sku", "left")


def visibility_master(inbound: DataFrame, samples: DataFrame) -> DataFrame:
    """The report table; `master_order` is for its sink."""
    return with_samples(inbound, samples).select(*MASTER_COLUMNS)


def master_order() -> list[Column]:
    """By receipt, booking and PO, missing first; item, reference and status break runs of equal dates."""
    return sort_keys(["date_received", "date_booked", "pos", "sku", "ref", "status"], nulls="first")


def warehouse_track(master: DataFrame) -> DataFrame:
    return master.select(*TRACK_COLUMNS)


def track_order() -> list[Column]:
    return sort_keys(["date_received", "pos", "last_qced", "sku", "ref", "status"], nulls="last")


def in_backlog() -> Column:
    """Received, not yet counted by quality control and not taken in by the warehouse."""
    return F.col("date_received").isNotNull() & F.col("last_qced").isNull() & F.col("last_received").isNull()


def backlog(master: DataFrame) -> DataFrame:
    return master.select(*TRACK_COLUMNS).filter(in_backlog())


def saleable(master: DataFrame) -> DataFrame:
    return exclude_matching(master, "ref", NOT_FOR_SALE_OR_REJECTED)


def config_rows(inbound: DataFrame) -> DataFrame:
    """Inbound rows reduced to at most two per PO, flagged, with the go-live week."""
    reduced = reduce_partial_deliveries(inbound, "config_sku", "pos", "last_qced", frame_order())
    return reduced.withColumn("gl_week", iso_week_day("gl_date"))


def config_funnel(inbound: DataFrame) -> DataFrame:
    first = ~F.col("is_repeat")
    measures = {
        "planned": first,
        "on_bp": first & F.col("pos").isNotNull(),
        "booked": first & F.col("date_booked").isNotNull(),
        "received": first & F.col("date_received").isNotNull(),
        "qced": first & F.col("last_qced").isNotNull(),
        "partial_delivery": F.col("is_repeat") & F.col("last_qced").isNull(),
        "live": first & F.col("live_date").isNotNull(),
        "not_live": first & F.col("live_date").isNull(),
    }
    return group_agg(config_rows(inbound), ["gl_month"], *conditional_counts(measures))


def units_by_month(with_sample_count: DataFrame) -> DataFrame:
    """Unit sums by month. Damaged units repeat per row of an item, see `inbound_data`."""
    names = {
        "units_planned": "total_units",
        "units_qced": "qty_counted",
        "sample_count": "sample_count",
        "qty_damaged": "qty_damaged",
        "units_taken_in": "qty_received",
        "units_in_wh": "qty_putaway",
    }
    sums = [F.sum(c).alias(name) for name, c in names.items()]
    return group_agg(saleable(with_sample_count), ["gl_month"], *sums)


PO_RATIOS = ("pos_on_bp", "booked", "received", "not_received", "partial", "qced", "in_wh")


def po_progress(with_sample_count: DataFrame) -> DataFrame:
    """PO counts by month as shares of the POs of that month."""
    orders = saleable(with_sample_count).filter(F.col("pos").isNotNull())
    reduced = reduce_partial_deliveries(orders, "pos", "pos", "last_qced", frame_order())
    first = ~F.col("is_repeat")
    measures = {
        "pos_on_bp": first,
        "booked": first & F.col("date_booked").isNotNull(),
        "received": first & F.col("date_received").isNotNull(),
        "not_received": first & F.col("date_received").isNull(),
        "partial": F.col("is_repeat") & F.col("last_qced").isNull(),
        "qced": first & F.col("last_qced").isNotNull(),
        "in_wh": first & F.col("last_received").isNotNull(),
    }
    counts = group_agg(reduced, ["gl_month"], *conditional_counts(measures))
    return scale_by_first(counts, PO_RATIOS)


def planned_cost() -> Column:
    return F.col("unit_cost") * F.col("total_units")


def working_capital(with_sample_count: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Cost of planned units by the first stage they have not reached."""
    received, booked = F.col("date_received"), F.col("date_booked")
    stages = {
        "not_on_bp": F.col("status").isNull(),
        "not_booked_not_delivered": received.isNull() & booked.isNull(),
        "booked_not_delivered": received.isNull(),
        "partial_delivery": F.col("last_qced").isNull(),
    }
    return waterfall(saleable(with_sample_count), ["gl_month"], planned_cost(), stages, missing_as_zero)


def config_weeks(inbound: DataFrame) -> DataFrame:
    return group_agg(config_rows(inbound), ["gl_week"], *present_counts(FUNNEL))


def go_live_orders(with_sample_count: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """PO counts per go-live day: one row per (PO, count date), first row per PO counts.

    After the first step a PO has one row per count date, so the window that flags its
    later rows is bounded by the calendar.
    """
    orders = saleable(with_sample_count).filter(F.col("pos").isNotNull())
    order = [nulls_last("last_qced"), *frame_order()]
    dated = keep_first(orders, ["pos", "last_qced"], order)
    flagged = flag_repeats_bounded(dated, ["pos"], order)
    first = ~F.col("is_repeat")
    measures = {
        "po_total": first,
        "po_draft": first & (F.col("status") == DRAFT),
        "po_received": first & F.col("date_received").isNotNull(),
        "not_received": first & F.col("date_received").isNull(),
    }
    return group_agg(flagged, list(keys), *conditional_counts(measures))


def po_summary(with_sample_count: DataFrame) -> DataFrame:
    return go_live_orders(with_sample_count, ("gl_month", "gl_day"))


def po_summary_per_buyer(with_sample_count: DataFrame) -> DataFrame:
    return go_live_orders(with_sample_count, ("buyer", "gl_month", "gl_day"))


def go_live_track(inbound: DataFrame, min_units: int | None = None) -> DataFrame:
    """Status funnel over the first row of each config, by go-live week and by month.

    `min_units` leaves out rows with fewer planned units, or none, before a config's first is taken.

    Both tabs come from one pass: each config counts once in either.
    """
    if min_units is not None:
        inbound = inbound.filter(F.col("total_units") >= min_units)
    configs = keep_first(inbound, ["config_sku"], frame_order())
    week = F.struct(F.lit("week").alias("tab"), iso_week_day("gl_date").cast("string").alias("period"))
    month = F.struct(F.lit("month").alias("tab"), F.col("gl_month").cast("string").alias("period"))
    both = configs.withColumn("slot", F.explode(F.array(week, month))).select("*", "slot.*")
    return group_agg(both, ["tab", "period"], *present_counts(FUNNEL))

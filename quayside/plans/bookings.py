"""Receiving schedule and supplier contacts from a dock booking export."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import (
    BOOKED_PO_STRIP,
    date_text,
    kv_fields,
    split_pieces,
    strip_chars,
    token_before,
)
from quayside.operators.dedupe import keep_first
from quayside.operators.predicates import differs
from quayside.operators.projections import overwrite_where
from quayside.operators.reshape import explode_pieces
from quayside.operators.setops import roll_history

# Fixed value: the fields of a booking, in the order the form asks for them.
BOOKING_FIELDS = ("brand", "pos", "boxes", "partial_delivery", "supplier")
MERCHANT_EVENT = "Merchant Delivery"
CONTACT_DAYS = 70


def booked_orders(export: DataFrame, exclude_cancelled: bool = False) -> DataFrame:
    """One row per booked PO number; a booking without a PO field keeps one row."""
    if exclude_cancelled:
        export = export.filter(differs("is_cancelled", "Yes"))
    fields = dict(zip(BOOKING_FIELDS, kv_fields("additional_fields", BOOKING_FIELDS)))
    wide = export.withColumns(fields).drop("additional_fields")
    pieces = explode_pieces(wide, "pos", split_pieces("pos"))
    return pieces.withColumn("pos", strip_chars("pos", BOOKED_PO_STRIP))


def next_workday(as_of: date) -> date:
    """Friday's report is for Monday; any other day's is for the day after."""
    return as_of + timedelta(days=3 if as_of.weekday() == 4 else 1)


def several_events(rows: DataFrame) -> Column:
    """Whether there is more than one kind of event, a missing one included; a subquery."""
    kinds = F.count_distinct("event") + F.max(F.col("event").isNull().cast("int"))
    return rows.agg((kinds > 1).alias("several")).scalar()


def receiving_report(
    export: DataFrame, as_of: date, merchant_event: str = MERCHANT_EVENT
) -> DataFrame:
    """Bookings of the next business day, one row per (PO, brand).

    Bookings with an empty PO are left out, those without a PO field are shown as `-`.
    If the day has more than one kind of event, merchant deliveries show their brand as
    supplier. The date filter is pushed below the parsing to the scan.
    """
    day = export.filter(F.col("bdate") == F.lit(next_workday(as_of)))
    rows = booked_orders(day).filter(differs("pos", ""))
    rows = rows.withColumns(
        {
            "bdate": date_text("bdate", "yyyy/MM/dd"),
            "btime": token_before("btime", "-"),
            "record_date": token_before("record_date", " "),
        }
    )
    first = keep_first(rows, ["pos", "brand"], ["seq", "piece"])
    several = several_events(first)
    named = first.withColumns(
        {
            "pos": F.coalesce("pos", F.lit("-")),
            "supplier": overwrite_where(
                "supplier", several & (F.col("event") == merchant_event), F.col("brand")
            ),
        }
    )
    return named.select(
        "bdate", "btime", "event", "pos", "supplier", "brand", "boxes", "partial_delivery"
    )


def contact_rows(export: DataFrame) -> DataFrame:
    """Who booked which PO. Rows with an empty PO stay, those without one do not."""
    rows = booked_orders(export).dropna(subset=["pos"])
    return rows.select(
        "seq",
        "piece",
        F.col("bdate").alias("date"),
        "event",
        "pos",
        "supplier",
        "brand",
        "client_name",
        "client_email",
    )


def rolling_contacts(
    history: DataFrame, export: DataFrame, as_of: date, days: int = CONTACT_DAYS
) -> DataFrame:
    return roll_history(history, contact_rows(export), as_of, days)

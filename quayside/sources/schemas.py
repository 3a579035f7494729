"""Explicit input schemas; nothing is inferred."""

from __future__ import annotations

# DDL per source table, in the order its columns are read.
PO_LINES = "sku string, pos string, ref string, status string, bp_qty bigint, contact string, name string"
PO_HEADER = "order_id_raw string, delivery_due date"
DOCK_LOG = (
    "seq bigint, pos string, date_booked string, partial_delivery string, date_received string"
)
QC_COUNTS = "pos string, sku string, qty_counted bigint, qc_date date"
DAMAGE_SHEET = "product_id string, reason string, responsible string"
OVERSUPPLY_SHEET = "sku string"
BOOKING_EXPORT = (
    "date string, time string, event string, client_name string, client_email string, "
    "is_cancelled string, record_date string, additional_fields string"
)
ROLLING_DAMAGES = "date string, pos string, sku string, reason string, responsible string"
ROLLING_OVERSUPPLY = "date string, supplier string, po string, sku string, oversupply string"

# The six stages a sample passes, in order.
SAMPLE_STAGES = (
    "s1_wh_out",
    "s2_room_in",
    "s3_to_studio",
    "s4_from_studio",
    "s5_room_out",
    "s6_wh_in",
)
SAMPLE_HISTORY = "sku string, " + ", ".join(f"{s} string" for s in SAMPLE_STAGES)

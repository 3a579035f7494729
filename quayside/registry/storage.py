"""Sources, sinks and the scan drain, exercised on copies written from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import fold_code
from quayside.operators.aggregates import group_agg
from quayside.operators.joins import outer_join_filled
from quayside.plans.scans import rolling_stock, scan_counts
from quayside.registry.core import AS_OF, SHIFT, inbound, query
from quayside.session import scratch_path
from quayside.sources import schemas
from quayside.sources.adapters import Tables
from quayside.sources.delimited import (
    read_booking_export,
    read_delimited,
    read_sheet,
    read_state_file,
)
from quayside.sources.sinks import write_delimited, write_per_value, write_report
from quayside.sources.tables import read_history_dir, read_snapshot, read_table
from quayside.streaming.scans import drain_scans


@query("src_01", "SELECT sku, pos, bp_qty FROM po_lines")
def delimited(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "po-lines")
    columns = [c.split()[0] for c in schemas.PO_LINES.split(", ")]
    t.po_lines.select(*columns).write.option("header", True).option(
        "encoding", "ISO-8859-1"
    ).csv(path)
    return read_delimited(t.spark, path, schemas.PO_LINES, ["sku", "pos", "bp_qty"])


@query(
    "src_02",
    """SELECT bdate AS date, event, client_name, replace(additional_fields, ', ', chr(10)) AS additional_fields
FROM booking_export""",
)
def booking_file(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "booking-export")
    names = [c.split()[0] for c in schemas.BOOKING_EXPORT.split(", ")]
    rows = t.booking_export.select(
        F.date_format("bdate", "dd/MM/yyyy").alias("date"),
        F.col("btime").alias("time"),
        "event",
        "client_name",
        "client_email",
        "is_cancelled",
        "record_date",
        F.replace("additional_fields", F.lit(", "), F.lit("\n")).alias("additional_fields"),
    )
    blank = [F.lit(None).cast("string").alias(c) for c in names[1:]]
    title = rows.agg(F.concat(F.lit("Bookings: "), F.count(F.lit(1))).alias("date"))
    header = title.select(*[F.lit(c).alias(c) for c in names])
    lines = title.select("date", *blank).unionByName(header).unionByName(rows)
    lines.write.option("quoteAll", True).option("escape", '"').csv(path)
    export = read_booking_export(t.spark, path, schemas.BOOKING_EXPORT)
    return export.select("date", "event", "client_name", "additional_fields")


STAGE_ROW = ", ".join(
    f"CASE WHEN stage = {i} THEN scan_date END AS {s}"
    for i, s in enumerate(schemas.SAMPLE_STAGES, 1)
)


@query("src_03", f"SELECT sku, {STAGE_ROW} FROM stage_scans")
def state_file(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sample-history")
    wide = t.stage_scans.selectExpr("sku", *STAGE_ROW.split(", "))
    text = [F.date_format(s, "dd/MM/yyyy").alias(s) for s in schemas.SAMPLE_STAGES]
    write_delimited(wide.select("sku", *text), path)
    back = read_state_file(t.spark, path, schemas.SAMPLE_HISTORY, schemas.SAMPLE_STAGES)
    return back.withColumns({s: F.to_date(s) for s in schemas.SAMPLE_STAGES})


@query(
    "src_04",
    """SELECT pos, try_cast(nullif(date_booked, '') AS DATE) AS date_booked,
  try_cast(nullif(date_received, '') AS DATE) AS date_received FROM dock_log""",
)
def relational_view(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "dock-view")
    t.dock_log.write.parquet(path)
    dates = ["date_booked", "date_received"]
    view = read_table(t.spark, path, ["pos", *dates], dates)
    return view.withColumns({d: F.to_date(d) for d in dates})


@query("src_05", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def snapshot(t: Tables) -> DataFrame:
    return read_snapshot(
        t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"]
    )


@query(
    "src_06",
    """SELECT nullif(pos, '') AS pos, nullif(date_booked, '') AS date_booked, nullif(partial_delivery, '') AS partial_delivery,
  nullif(date_received, '') AS date_received FROM dock_log""",
)
def sheet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "dock-sheet")
    columns = ["pos", "date_booked", "partial_delivery", "date_received"]
    t.dock_log.select(*columns).write.option("header", True).csv(path)
    return read_sheet(t.spark, path, columns)


SHIFT_COUNT = "product_id string, date date, qty_counted bigint"
COUNT_SQL = """SELECT upper(product_id) AS product_id, scan_date AS date, count(*) AS qty_counted
FROM stock_scans GROUP BY 1, 2"""


def write_shift_files(t: Tables, path: str) -> None:
    """Counts of every shift, a second copy of the later ones, and an unreadable file."""
    counts = scan_counts(
        t.stock_scans.withColumnRenamed("scan_date", "date"), "product_id", "qty_counted", "date"
    )
    ordered = counts.select("product_id", "date", "qty_counted")
    ordered.write.parquet(path)
    ordered.filter(F.col("date") >= "2024-01-15").write.mode("append").parquet(path)
    ordered.agg(F.concat(F.lit("rows: "), F.count(F.lit(1))).alias("value")).write.mode(
        "append"
    ).text(path)


@query("src_07", f"{COUNT_SQL} UNION ALL SELECT * FROM ({COUNT_SQL}) WHERE date >= DATE '2024-01-15'")
def history_dir(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "shift-files")
    write_shift_files(t, path)
    return read_history_dir(t.spark, path, SHIFT_COUNT, skip_unreadable=True)


@query(
    "src_08",
    """SELECT upper(product_id) AS sku, reason, count(*) AS damaged, CAST(NULL AS BIGINT) AS oversupply
FROM damage_scans GROUP BY 1, 2""",
)
def empty_sheet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "empty-sheet")
    nothing = t.oversupply_scans.filter(F.col("scan_date") > SHIFT).select("sku")
    nothing.write.option("header", True).csv(path)
    surplus = scan_counts(read_sheet(t.spark, path, ["sku"]), "sku", "oversupply")
    damaged = scan_counts(t.damage_scans, "product_id", "damaged", "reason")
    rows = outer_join_filled(damaged, surplus, "product_id", "sku", "sku")
    return rows.select("sku", "reason", "damaged", "oversupply")


@query(
    "snk_01",
    """SELECT scan_date AS date, upper(product_id) AS sku, reason, responsible FROM damage_scans""",
)
def text_state(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "rolling-damages")
    rows = t.damage_scans.select(
        F.col("scan_date").alias("date"), fold_code("product_id").alias("sku"), "reason", "responsible"
    )
    write_delimited(rows, path)
    schema = "date date, sku string, reason string, responsible string"
    return read_delimited(t.spark, path, schema, sep=";", encoding="UTF-8")


@query(
    "snk_02",
    """SELECT buyer, sku, pos, total_units FROM inbound WHERE buyer IS NOT NULL""",
)
def per_buyer(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "per-buyer")
    write_per_value(inbound(t).select("buyer", "sku", "pos", "total_units"), path, "buyer")
    schema = "sku string, pos string, total_units bigint, buyer string"
    return t.spark.read.schema(schema).parquet(path).select("buyer", "sku", "pos", "total_units")


@query(
    "snk_03",
    """SELECT 'by_status' AS tab, status AS label, CAST(sum(bp_qty) AS BIGINT) AS qty FROM po_lines
WHERE status IS NOT NULL GROUP BY status
UNION ALL SELECT 'by_contact', contact, CAST(sum(bp_qty) AS BIGINT) FROM po_lines GROUP BY contact""",
)
def report_bundle(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "reports")
    tabs = {
        "by_status": group_agg(t.po_lines, ["status"], F.sum("bp_qty").alias("qty")),
        "by_contact": group_agg(t.po_lines, ["contact"], F.sum("bp_qty").alias("qty")),
    }
    named = {k: v.withColumnRenamed(v.columns[0], "label") for k, v in tabs.items()}
    write_report(root, "orders", named, AS_OF)
    schema = "label string, qty bigint, tab string, as_of date"
    return t.spark.read.schema(schema).parquet(f"{root}/report=orders").select(
        "tab", "label", "qty"
    )


@query(
    "stm_01",
    """SELECT upper(product_id) AS product_id, reason, responsible, DATE '2024-01-31' AS shift
FROM damage_scans""",
)
def drained(t: Tables) -> DataFrame:
    """The inbox is drained twice; the second run finds nothing new."""
    root = scratch_path(t.spark, "drain")
    sheet = t.damage_scans.select("product_id", "reason", "responsible")
    sheet.write.option("header", True).csv(f"{root}/inbox")
    for _ in range(2):
        drain_scans(
            t.spark,
            f"{root}/inbox",
            f"{root}/history",
            f"{root}/checkpoint",
            schemas.DAMAGE_SHEET,
            "product_id",
            shift=SHIFT,
        )
    return t.spark.read.parquet(f"{root}/history")


@query(
    "pipe_05",
    COUNT_SQL,
)
def rolling_counts(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "all-handovers")
    write_shift_files(t, path)
    return rolling_stock(t.spark, path, SHIFT_COUNT, skip_unreadable=True)

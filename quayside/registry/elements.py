"""Projections, filters, scalar functions, joins, row order, sorting, unions, reshaping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import (
    busdays,
    days_apart,
    iso_week_day,
    next_business_day,
    parse_timestamp,
    shift_days,
    shift_month,
    year_month,
)
from quayside.functions.numeric import (
    classify_last_match,
    flat_tariff,
    gap,
    ratio,
    started_units,
    zoned_tariff,
)
from quayside.functions.text import (
    BOOKED_PO_STRIP,
    HEADER_PO_STRIP,
    as_key,
    config_code,
    date_text,
    fold_code,
    holds,
    kv_fields,
    prefix,
    split_pieces,
    strip_chars,
    token_before,
)
from quayside.operators.aggregates import group_agg, present_counts
from quayside.operators.dedupe import (
    attribute_to_first,
    flag_repeats,
    keep_first,
    keep_last,
    reduce_partial_deliveries,
)
from quayside.operators.joins import fan_out_join, left_join, outer_join_filled, right_join
from quayside.operators.predicates import (
    DELETED,
    DRAFT,
    NOT_FOR_SALE,
    NOT_FOR_SALE_OR_REJECTED,
    OVERSUPPLY,
    differs,
    drop_missing,
    exclude_matching,
    include_matching,
    matches,
    month_window,
    not_cancelled,
    outside,
    placed,
    shorter_than,
)
from quayside.operators.projections import (
    blanks_to_null,
    fill_key,
    indicator,
    item_key,
    overwrite_where,
    project,
    stamp,
)
from quayside.operators.reshape import explode_pieces
from quayside.operators.setops import consolidate, roll_history, stack
from quayside.operators.sorting import sort_keys
from quayside.plans import samples as samples_plan
from quayside.plans.bookings import BOOKING_FIELDS, booked_orders, next_workday
from quayside.plans.inbound import DOCK_DATE_FORMATS, frame_order, po_line_groups
from quayside.plans.forecast import DAYS_BEFORE_GO_LIVE
from quayside.plans.scans import counted_less_ordered, scan_counts
from quayside.plans.visibility import in_backlog, planned_cost
from quayside.registry.core import (
    AS_OF,
    BLANK,
    BOOKING_DAY,
    PARTS,
    SCAN_DAY,
    SHIFT,
    inbound,
    query,
    rounded,
)
from quayside.sources.adapters import Tables
from quayside.sources.schemas import SAMPLE_STAGES

# --- projections -----------------------------------------------------------------


@query(
    "prj_01",
    "SELECT gl_month AS month, buyer AS employee, simple_sku AS sku, total_units AS units FROM plan_items",
)
def renamed(t: Tables) -> DataFrame:
    return project(
        t.plan_items,
        {"month": "gl_month", "employee": "buyer", "sku": "simple_sku", "units": "total_units"},
    )


@query(
    "prj_02",
    "SELECT product_id, DATE '2024-01-31' AS shift, 'A' AS team FROM stock_scans",
)
def stamped(t: Tables) -> DataFrame:
    return stamp(t.stock_scans.select("product_id"), shift=SHIFT, team="A")


@query(
    "prj_03",
    """SELECT seq, CASE WHEN pos <> '' THEN pos END AS pos,
  CASE WHEN date_booked <> '' THEN date_booked END AS date_booked, nullif(partial_delivery, '') AS partial_delivery,
  CASE WHEN date_received <> '' THEN date_received END AS date_received FROM dock_log""",
)
def without_blanks(t: Tables) -> DataFrame:
    return blanks_to_null(t.dock_log)


@query(
    "prj_04",
    """SELECT seq, CASE WHEN barcode <> '' THEN barcode WHEN ean <> '' THEN ean ELSE simple_sku END AS sku
FROM plan_items""",
)
def keyed(t: Tables) -> DataFrame:
    return t.plan_items.select("seq", item_key("barcode", "ean", "simple_sku").alias("sku"))


@query(
    "prj_05",
    """SELECT CASE WHEN b.sku IS NULL THEN a.sku ELSE b.sku END AS sku, a.n AS damaged, b.n AS oversupply
FROM (SELECT upper(product_id) AS sku, count(*) AS n FROM damage_scans GROUP BY 1) a
FULL JOIN (SELECT upper(sku) AS sku, count(*) AS n FROM oversupply_scans GROUP BY 1) b ON a.sku = b.sku""",
)
def filled_key(t: Tables) -> DataFrame:
    a = scan_counts(t.damage_scans, "product_id", "damaged")
    b = scan_counts(t.oversupply_scans, "sku", "oversupply")
    joined = a.join(b, F.col("product_id") == F.col("sku"), "full")
    return joined.select(fill_key("sku", "product_id").alias("sku"), "damaged", "oversupply")


@query(
    "prj_06",
    """SELECT sku, pos, ref, CASE WHEN regexp_matches(ref, 'OS|Os|OVERSUPPLY') THEN NULL ELSE bp_qty END AS bp_qty,
  CASE WHEN status IS NULL THEN 'unknown' ELSE status END AS status FROM po_lines""",
)
def overwritten(t: Tables) -> DataFrame:
    blanked = overwrite_where("bp_qty", matches("ref", OVERSUPPLY), F.lit(None).cast("long"))
    known = overwrite_where("status", F.col("status").isNull(), "unknown")
    return t.po_lines.select(
        "sku", "pos", "ref", blanked.alias("bp_qty"), known.alias("status")
    )


@query(
    "prj_07",
    """SELECT seq, round(unit_cost * total_units, 4) AS cost, total_units - 10 AS units_diff FROM plan_items""",
)
def arithmetic(t: Tables) -> DataFrame:
    spare = counted_less_ordered("total_units", F.lit(10)).alias("units_diff")
    return rounded(t.plan_items.select("seq", planned_cost().alias("cost"), spare), 4)


@query(
    "prj_08",
    """SELECT seq, pos, CASE WHEN last_qced IS NOT NULL THEN 1 END AS at_wh, status IS NULL AS no_bp,
  date_received IS NULL AND date_booked IS NULL AS nbnd, date_received IS NULL AS nd,
  last_qced IS NULL AS not_qced, last_received IS NULL AS not_taken_in FROM inbound""",
)
def indicators(t: Tables) -> DataFrame:
    return inbound(t).select(
        "seq",
        "pos",
        indicator("last_qced").alias("at_wh"),
        F.col("status").isNull().alias("no_bp"),
        (F.col("date_received").isNull() & F.col("date_booked").isNull()).alias("nbnd"),
        F.col("date_received").isNull().alias("nd"),
        F.col("last_qced").isNull().alias("not_qced"),
        F.col("last_received").isNull().alias("not_taken_in"),
    )


# --- filters ---------------------------------------------------------------------


@query(
    "flt_01",
    f"""SELECT sku, pos, ref, bp_qty FROM po_lines
WHERE NOT coalesce(regexp_matches(ref, '{BLANK}|not OK'), false)""",
)
def excluded(t: Tables) -> DataFrame:
    return exclude_matching(t.po_lines, "ref", NOT_FOR_SALE_OR_REJECTED).select(
        "sku", "pos", "ref", "bp_qty"
    )


@query(
    "flt_02",
    f"SELECT sku, pos, ref, bp_qty FROM po_lines WHERE regexp_matches(ref, '{BLANK}')",
)
def included(t: Tables) -> DataFrame:
    return include_matching(t.po_lines, "ref", NOT_FOR_SALE).select("sku", "pos", "ref", "bp_qty")


@query(
    "flt_03",
    """SELECT 'not cancelled' AS rule, sku, pos, status FROM po_lines WHERE status NOT LIKE '%Cancel PO%'
UNION ALL SELECT 'placed', sku, pos, status FROM po_lines WHERE status <> 'Draft PO'""",
)
def by_status(t: Tables) -> DataFrame:
    lines = t.po_lines.select("sku", "pos", "status")
    kept = stamp(lines.filter(not_cancelled("status")), rule="not cancelled")
    return kept.unionByName(stamp(lines.filter(placed("status")), rule="placed"))


@query(
    "flt_04",
    """SELECT seq, simple_sku FROM plan_items
WHERE total_cost > 0 AND procurement_status IS DISTINCT FROM 'Deleted' AND gl_month < 12 AND total_units > 0""",
)
def numeric_filters(t: Tables) -> DataFrame:
    return t.plan_items.filter(
        (F.col("total_cost") > 0)
        & differs("procurement_status", DELETED)
        & (F.col("gl_month") < 12)
        & (F.col("total_units") > 0)
    ).select("seq", "simple_sku")


@query(
    "flt_05",
    """SELECT 'subset' AS rule, sku, pos, ref, status FROM po_lines WHERE ref IS NOT NULL AND status IS NOT NULL
UNION ALL SELECT 'all', NULL, NULL, ref, status FROM po_lines WHERE ref IS NOT NULL OR status IS NOT NULL
UNION ALL SELECT 'one', sku, pos, ref, NULL FROM po_lines WHERE ref IS NOT NULL""",
)
def missing_dropped(t: Tables) -> DataFrame:
    lines = t.po_lines.select("sku", "pos", "ref", "status")
    rules = {
        "subset": drop_missing(lines, ["ref", "status"]),
        "all": drop_missing(lines.select("ref", "status"), how="all"),
        "one": drop_missing(lines.select("sku", "pos", "ref"), ["ref"], min_present=1),
    }
    return stack([stamp(df, rule=rule) for rule, df in rules.items()])


@query(
    "flt_06",
    """SELECT seq, gl_year, gl_month FROM plan_items
WHERE make_date(gl_year, gl_month, 1) BETWEEN DATE '1996-12-01' AND DATE '1997-04-01'""",
)
def in_months(t: Tables) -> DataFrame:
    window = month_window(t.plan_items, "gl_year", "gl_month", AS_OF, 3, 1)
    return window.select("seq", "gl_year", "gl_month")


@query(
    "flt_07",
    """SELECT message_reference, item_code FROM received_msgs WHERE length(message_reference) <= 6""",
)
def short_references(t: Tables) -> DataFrame:
    return t.received_msgs.filter(shorter_than("message_reference", 7)).select(
        "message_reference", "item_code"
    )


@query(
    "flt_08",
    """SELECT shipment_id, zone, zone IS NULL OR zone NOT IN ('Main Centre', 'Local') AS is_outside
FROM shipments WHERE substr(shipment_id, 1, 3) = 'SPR' OR substr(shipment_id, 1, 3) = 'COL'""",
)
def membership(t: Tables) -> DataFrame:
    kind = prefix("shipment_id", 3)
    return t.shipments.filter((kind == "SPR") | (kind == "COL")).select(
        "shipment_id", "zone", outside("zone", ["Main Centre", "Local"]).alias("is_outside")
    )


@query(
    "flt_09",
    """SELECT 'inventory' AS source, simple_sku AS code FROM inventory WHERE inv_date = DATE '1996-09-27'
UNION ALL SELECT 'booking', client_name FROM booking_export WHERE bdate = DATE '1996-09-30'""",
)
def on_date(t: Tables) -> DataFrame:
    today = t.inventory.filter(F.col("inv_date") == F.lit(BOOKING_DAY))
    day = t.booking_export.filter(F.col("bdate") == F.lit(next_workday(BOOKING_DAY)))
    a = stamp(today.select(F.col("simple_sku").alias("code")), source="inventory")
    return a.unionByName(stamp(day.select(F.col("client_name").alias("code")), source="booking"))


@query(
    "flt_10",
    "SELECT seq, gl_month FROM plan_items WHERE gl_year = 1997 AND gl_month = 2",
)
def previous_month(t: Tables) -> DataFrame:
    year, month = shift_month(AS_OF, -1)
    return t.plan_items.filter(
        (F.col("gl_year") == year) & (F.col("gl_month") == month)
    ).select("seq", "gl_month")


@query(
    "flt_11",
    """SELECT sku, pos, date_received FROM inbound
WHERE date_received IS NOT NULL AND last_qced IS NULL AND last_received IS NULL""",
)
def waiting(t: Tables) -> DataFrame:
    return inbound(t).filter(
        in_backlog()
    ).select("sku", "pos", "date_received")


# --- text ------------------------------------------------------------------------


@query("str_01", "SELECT seq, upper(product_id) AS product_id FROM damage_scans")
def folded(t: Tables) -> DataFrame:
    return t.damage_scans.select("seq", fold_code("product_id").alias("product_id"))


@query("str_02", "SELECT CAST(o_orderkey AS VARCHAR) AS pos FROM orders")
def stripped(t: Tables) -> DataFrame:
    return t.po_header.select(strip_chars("order_id_raw", HEADER_PO_STRIP).alias("pos"))


@query(
    "str_03",
    """SELECT seq, string_split(string_split(additional_fields, ';')[1], ': ')[2] AS brand,
  string_split(string_split(additional_fields, ';')[2], ': ')[2] AS pos,
  string_split(string_split(additional_fields, ';')[3], ': ')[2] AS boxes,
  string_split(string_split(additional_fields, ';')[4], ': ')[2] AS partial_delivery,
  string_split(string_split(additional_fields, ';')[5], ': ')[2] AS supplier
FROM booking_export""",
)
def fields(t: Tables) -> DataFrame:
    return t.booking_export.select("seq", *kv_fields("additional_fields", BOOKING_FIELDS))


@query(
    "str_04",
    r"""SELECT seq, len(string_split_regex(additional_fields, '\n|/ |, | ')) AS n_pieces,
  string_split_regex(additional_fields, '\n|/ |, | ')[2] AS second FROM booking_export""",
)
def pieces(t: Tables) -> DataFrame:
    parts = split_pieces("additional_fields")
    return t.booking_export.select(
        "seq",
        F.size(parts).cast("long").alias("n_pieces"),
        F.get(parts, F.lit(1)).alias("second"),
    )


@query(
    "str_05",
    """SELECT seq, left(sku, 3) AS start, CASE WHEN length(sku) = 11 THEN left(sku, 7) ELSE sku END AS config_sku
FROM stage_scans""",
)
def codes(t: Tables) -> DataFrame:
    return t.stage_scans.select(
        "seq", prefix("sku", 3).alias("start"), config_code("sku").alias("config_sku")
    )


@query(
    "str_06",
    """SELECT seq, string_split(btime, '-')[1] AS start, string_split(record_date, ' ')[1] AS recorded
FROM booking_export""",
)
def first_tokens(t: Tables) -> DataFrame:
    return t.booking_export.select(
        "seq",
        token_before("btime", "-").alias("start"),
        token_before("record_date", " ").alias("recorded"),
    )


@query(
    "str_07",
    """SELECT shipment_id, zone, position('National' IN zone) > 0 AS has_national,
  position('Outlying' IN zone) > 0 AS has_outlying FROM shipments""",
)
def substrings(t: Tables) -> DataFrame:
    return t.shipments.select(
        "shipment_id",
        "zone",
        holds("zone", "National").alias("has_national"),
        holds("zone", "Outlying").alias("has_outlying"),
    )


@query(
    "str_08",
    """SELECT event_id, strftime(ts, '%Y/%m/%d') AS day, strftime(ts, '%Y-%m-%d %H:%M') AS shift FROM events""",
)
def date_texts(t: Tables) -> DataFrame:
    return t.driver("events").select(
        "event_id",
        date_text("ts", "yyyy/MM/dd").alias("day"),
        date_text("ts", "yyyy-MM-dd HH:mm").alias("shift"),
    )


@query(
    "str_09",
    "SELECT CAST(l_orderkey AS VARCHAR) AS pos, l_linenumber FROM lineitem",
)
def text_keys(t: Tables) -> DataFrame:
    return t.driver("lineitem").select(as_key("l_orderkey").alias("pos"), "l_linenumber")


# --- dates and numbers -----------------------------------------------------------


# Every third booking is written day first.
TYPED_DATE = (
    "CASE WHEN seq % 3 = 0 AND date_booked <> '' THEN concat(substr(date_booked, 9, 2), '/', "
    "substr(date_booked, 6, 2), '/', substr(date_booked, 1, 4)) ELSE date_booked END"
)


@query(
    "dat_01",
    f"""SELECT seq, coalesce(try_strptime(typed, '%Y-%m-%d'), try_strptime(typed, '%d/%m/%Y')) AS booked
FROM (SELECT seq, {TYPED_DATE} AS typed FROM dock_log)""",
)
def parsed_dates(t: Tables) -> DataFrame:
    booked = parse_timestamp(F.expr(TYPED_DATE), DOCK_DATE_FORMATS)
    return t.dock_log.select("seq", booked.alias("booked"))


@query(
    "dat_02",
    """SELECT sku, pos, CAST(abs(date_diff('day', date_received, date_booked)) AS DOUBLE) AS missed_booking,
  CAST(abs(date_diff('day', delivery_due, date_received)) AS DOUBLE) AS missed_plan FROM inbound""",
)
def day_differences(t: Tables) -> DataFrame:
    return inbound(t).select(
        "sku",
        "pos",
        days_apart("date_received", "date_booked").alias("missed_booking"),
        days_apart("delivery_due", "date_received").alias("missed_plan"),
    )


@query(
    "dat_03",
    """SELECT seq, gl_date - 14 AS due, gl_date + 1 AS next FROM plan_items""",
)
def shifted_dates(t: Tables) -> DataFrame:
    return t.plan_items.select(
        "seq", shift_days("gl_date", -DAYS_BEFORE_GO_LIVE).alias("due"), shift_days("gl_date", 1).alias("next")
    )


@query(
    "dat_04",
    """SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) + 2 AS week FROM orders""",
)
def wednesdays(t: Tables) -> DataFrame:
    return t.driver("orders").select("o_orderkey", iso_week_day("o_orderdate").alias("week"))


@query(
    "dat_05",
    """SELECT o_orderkey, CAST(date_part('month', o_orderdate) AS INTEGER) AS month,
  CAST(date_part('year', o_orderdate) AS INTEGER) AS year FROM orders""",
)
def month_parts(t: Tables) -> DataFrame:
    year, month = year_month("o_orderdate")
    return t.driver("orders").select("o_orderkey", month.alias("month"), year.alias("year"))


# Weekdays strictly counted day by day: an independent form of the closed formula.
BUSDAYS_SQL = """CAST(CASE
  WHEN pod_date >= poh_date THEN (SELECT count(*) FROM range(CAST(date_diff('day', poh_date, pod_date) AS BIGINT)) r(i)
    WHERE isodow(poh_date + CAST(i AS INTEGER)) < 6)
  WHEN pod_date < poh_date THEN -(SELECT count(*) FROM range(CAST(date_diff('day', pod_date, poh_date) AS BIGINT)) r(i)
    WHERE isodow(pod_date + CAST(i + 1 AS INTEGER)) < 6)
  END AS BIGINT)"""


@query(
    "dat_06",
    f"""SELECT s.shipment_id, s.poh_date, s.pod_date, d.delay FROM shipments s
LEFT JOIN (SELECT poh_date, pod_date, {BUSDAYS_SQL} AS delay
  FROM (SELECT DISTINCT poh_date, pod_date FROM shipments)) d
ON s.poh_date = d.poh_date AND s.pod_date = d.pod_date""",
)
def workdays(t: Tables) -> DataFrame:
    return t.shipments.select(
        "shipment_id", "poh_date", "pod_date", busdays("poh_date", "pod_date").alias("delay")
    )


@query(
    "dat_07",
    """SELECT o_orderkey, CASE isodow(o_orderdate) WHEN 5 THEN CAST(o_orderdate AS DATE) + 3
  ELSE CAST(o_orderdate AS DATE) + 1 END AS next FROM orders""",
)
def next_days(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.driver("orders").select("o_orderkey", next_business_day(day).alias("next"))


@query(
    "num_01",
    "SELECT shipment_id, chargeable_mass, CAST(ceil(chargeable_mass / 1000.0) AS BIGINT) AS kg FROM shipments",
)
def kilograms(t: Tables) -> DataFrame:
    return t.shipments.select(
        "shipment_id", "chargeable_mass", started_units("chargeable_mass", 1000.0).alias("kg")
    )


@query(
    "num_02",
    "SELECT seq, CASE WHEN total_units < 25 THEN 25 - total_units ELSE total_units - 25 END AS gap FROM plan_items",
)
def absolute(t: Tables) -> DataFrame:
    return t.plan_items.select("seq", gap("total_units", F.lit(25)).alias("gap"))


@query(
    "num_03",
    "SELECT seq, round(unit_cost / nullif(total_cost, 0), 6) AS share FROM plan_items",
)
def ratios(t: Tables) -> DataFrame:
    return rounded(t.plan_items.select("seq", ratio("unit_cost", "total_cost").alias("share")))


MAIN_ZONES = "('Main Centre', 'Local', 'Main Township', 'Local Township')"
FLAT_SQL = """CASE WHEN chargeable_mass > 1000 THEN 40.90 + 5.50 * ceil(chargeable_mass / 1000.0) + 6.75
  WHEN chargeable_mass <= 1000 THEN 47.65 END"""
ZONED_SQL = f"""CASE
  WHEN chargeable_mass <= 2000 AND zone IN {MAIN_ZONES} THEN 54.57
  WHEN chargeable_mass <= 2000 THEN 81.43
  WHEN zone IN {MAIN_ZONES} THEN 54.57 + 4.95 * ceil(chargeable_mass / 1000.0)
  WHEN chargeable_mass > 2000 THEN 81.43 + 6.86 * ceil(chargeable_mass / 1000.0) END"""


@query(
    "num_04",
    f"""SELECT shipment_id, chargeable_mass, zone, round(CAST({FLAT_SQL} AS DOUBLE), 4) AS post_office,
  round(CAST({ZONED_SQL} AS DOUBLE), 4) AS counter FROM shipments""",
)
def tariffs(t: Tables) -> DataFrame:
    return rounded(
        t.shipments.select(
            "shipment_id",
            "chargeable_mass",
            "zone",
            flat_tariff("chargeable_mass").alias("post_office"),
            zoned_tariff("chargeable_mass", "zone").alias("counter"),
        ),
        4,
    )


ZONE_SQL = """CASE zone WHEN 'Local' THEN 'Local' WHEN 'Local Township' THEN 'Local' WHEN 'Main Centre' THEN 'Main'
  WHEN 'Main Township' THEN 'Main' WHEN 'Outlying' THEN 'Outlying'
  WHEN 'Regional Outlying' THEN 'Post office/Post-Net' WHEN 'National' THEN 'Speed Services'
  WHEN 'International' THEN 'International' END"""


@query("num_05", f"SELECT shipment_id, zone, {ZONE_SQL} AS sla_zone FROM shipments")
def zones(t: Tables) -> DataFrame:
    return t.shipments.select(
        "shipment_id", "zone", classify_last_match("zone").alias("sla_zone")
    )


# --- joins -----------------------------------------------------------------------


@query(
    "jn_01",
    """SELECT p.seq, p.simple_sku AS sku, l.pos, l.bp_qty FROM plan_items p LEFT JOIN po_lines l ON p.simple_sku = l.sku""",
)
def plan_with_lines(t: Tables) -> DataFrame:
    plan = t.plan_items.select("seq", F.col("simple_sku").alias("sku"))
    lines = t.po_lines.select("sku", "pos", "bp_qty")
    return fan_out_join(plan, lines, "sku").select("seq", "sku", "pos", "bp_qty")


@query(
    "jn_02",
    """SELECT bp.sku, bp.pos, bp.ref, bp.status, bp.bp_qty, q.qty_counted, q.last_qced
FROM bp LEFT JOIN qced q ON bp.sku = q.sku AND bp.pos = q.pos""",
)
def lines_with_counts(t: Tables) -> DataFrame:
    counts = t.qc_counts.groupBy("sku", "pos").agg(
        F.sum("qty_counted").alias("qty_counted"), F.max("qc_date").alias("last_qced")
    )
    return left_join(po_line_groups(t.po_lines), counts, ["sku", "pos"])


@query(
    "jn_03",
    """SELECT i.simple_sku, i.inv_date, i.qc_bad_qty, p.purchase_order_number
FROM inventory i LEFT JOIN po_items p ON p.simple_sku = i.simple_sku""",
)
def items_right_inventory(t: Tables) -> DataFrame:
    items = t.po_items.select("simple_sku", "purchase_order_number")
    stock = t.inventory.select("simple_sku", "inv_date", "qc_bad_qty")
    return right_join(items, stock, "simple_sku").select(
        "simple_sku", "inv_date", "qc_bad_qty", "purchase_order_number"
    )


@query(
    "jn_04",
    """SELECT coalesce(b.sku, a.sku) AS sku, a.reason, a.n AS damaged, b.n AS oversupply
FROM (SELECT upper(product_id) AS sku, reason, count(*) AS n FROM damage_scans GROUP BY 1, 2) a
FULL JOIN (SELECT upper(sku) AS sku, count(*) AS n FROM oversupply_scans GROUP BY 1) b ON a.sku = b.sku""",
)
def damages_and_surplus(t: Tables) -> DataFrame:
    a = scan_counts(t.damage_scans, "product_id", "damaged", "reason")
    b = scan_counts(t.oversupply_scans, "sku", "oversupply")
    rows = outer_join_filled(a, b, "product_id", "sku", "sku")
    return rows.select("sku", "reason", "damaged", "oversupply")


def stage_history(t: Tables) -> tuple[DataFrame, DataFrame]:
    """History up to the scan day, a wide row per item and week, and the scans since."""
    before = F.col("scan_date") < F.lit(SCAN_DAY)
    stages = [
        F.max(F.when(F.col("stage") == i, F.col("scan_date"))).alias(s)
        for i, s in enumerate(SAMPLE_STAGES, 1)
    ]
    scans = t.stage_scans
    week = F.floor(F.datediff("scan_date", F.lit("1970-01-01").cast("date")) / 7)
    rows = scans.filter(before).groupBy("sku", week.alias("_week"))
    history = rows.agg(F.max("seq").alias("seq"), *stages)
    return history.select("seq", "sku", *SAMPLE_STAGES), scans.filter(~before)


STAGES = ", ".join(SAMPLE_STAGES)
WIDE = ", ".join(
    f"max(CASE WHEN stage = {i} THEN scan_date END) AS {s}" for i, s in enumerate(SAMPLE_STAGES, 1)
)
PARTS["sample_history"] = f"""
SELECT * FROM (
  SELECT sku, max(seq) AS seq, {WIDE} FROM stage_scans WHERE scan_date < DATE '2024-01-20'
  GROUP BY sku, floor((scan_date - DATE '1970-01-01') / 7)
) QUALIFY row_number() OVER (PARTITION BY sku, {SAMPLE_STAGES[0]} ORDER BY seq DESC) = 1"""


def stage_sql(i: int, stage: str) -> str:
    return f"""SELECT DISTINCT sku, {stage} AS s FROM sample_history WHERE sku IS NOT NULL AND {stage} IS NOT NULL
UNION ALL SELECT upper(sku), DATE '2024-01-31' FROM stage_scans WHERE stage = {i} AND scan_date >= DATE '2024-01-20'"""


STAGE_TABLES = [stage_sql(i, s) for i, s in enumerate(SAMPLE_STAGES, 1)]
# Every combination of the stages of an item, as the literal steps build them.
STAGE_JOINS = f"(SELECT sku, s AS {SAMPLE_STAGES[0]} FROM ({STAGE_TABLES[0]})) t1" + "".join(
    f" FULL JOIN (SELECT sku, s AS {s} FROM ({text})) t{i} USING (sku)"
    for i, (s, text) in enumerate(zip(SAMPLE_STAGES[1:], STAGE_TABLES[1:], strict=True), 2)
)
# The last time of each stage, side by side.
LAST_JOINS = f"(SELECT sku, max(s) AS {SAMPLE_STAGES[0]} FROM ({STAGE_TABLES[0]}) GROUP BY sku) t1" + "".join(
    f" FULL JOIN (SELECT sku, max(s) AS {s} FROM ({text}) GROUP BY sku) t{i} USING (sku)"
    for i, (s, text) in enumerate(zip(SAMPLE_STAGES[1:], STAGE_TABLES[1:], strict=True), 2)
)


@query("jn_05", f"SELECT sku, {STAGES} FROM {LAST_JOINS}")
def six_stages(t: Tables) -> DataFrame:
    return samples_plan.latest_stages(samples_plan.stage_rows(*stage_history(t), SHIFT))


@query(
    "jn_06",
    """SELECT seq, client_name, regexp_extract(additional_fields, 'Brand: ([^;]*)', 1) AS brand,
  regexp_extract(additional_fields, 'Boxes: ([^;]*)', 1) AS boxes FROM booking_export""",
)
def fields_on_row(t: Tables) -> DataFrame:
    parsed = kv_fields("additional_fields", BOOKING_FIELDS)
    return t.booking_export.select("seq", "client_name", *parsed).select(
        "seq", "client_name", "brand", "boxes"
    )


PIECES_SQL = r"""
SELECT b.*, trim(u.piece_text, ' ()#abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-&:.%') AS pos, u.i AS piece
FROM (SELECT *, regexp_extract(additional_fields, 'POs: ([^;]*)', 1) AS po_text,
  regexp_extract(additional_fields, 'Brand: ([^;]*)', 1) AS brand,
  regexp_extract(additional_fields, 'Boxes: ([^;]*)', 1) AS boxes,
  regexp_extract(additional_fields, 'Partial: ([^;]*)', 1) AS partial_delivery,
  regexp_extract(additional_fields, 'Supplier: ([^;]*)', 1) AS supplier FROM booking_export) b
CROSS JOIN LATERAL (
  SELECT unnest(string_split_regex(b.po_text, '\n|/ |, | ')) AS piece_text,
    generate_subscripts(string_split_regex(b.po_text, '\n|/ |, | '), 1) AS i
) u"""


@query("jn_07", f"SELECT seq, client_name, pos FROM ({PIECES_SQL})")
def pieces_on_row(t: Tables) -> DataFrame:
    return booked_orders(t.booking_export).select("seq", "client_name", "pos")


@query(
    "jn_08",
    """SELECT seq, sku, pos, ref, status, date_booked, date_received, qty_counted, qty_damaged, qty_received
FROM inbound""",
)
def enriched(t: Tables) -> DataFrame:
    return inbound(t).select(
        "seq",
        "sku",
        "pos",
        "ref",
        "status",
        "date_booked",
        "date_received",
        "qty_counted",
        "qty_damaged",
        "qty_received",
    )


# --- row order -------------------------------------------------------------------


@query(
    "win_01",
    """SELECT d.pos, d.seq, d.date_booked FROM dock_log d
WHERE d.date_booked <> '' AND d.pos <> '' AND NOT EXISTS (
  SELECT 1 FROM dock_log e WHERE e.pos = d.pos AND e.date_booked <> '' AND e.seq < d.seq)""",
)
def first_bookings(t: Tables) -> DataFrame:
    booked = t.dock_log.filter((F.col("date_booked") != "") & (F.col("pos") != ""))
    return keep_first(booked, ["pos"], ["seq"]).select("pos", "seq", "date_booked")


@query(
    "win_02",
    """SELECT p.seq, p.simple_sku, p.gl_month FROM plan_items p WHERE p.seq = (
  SELECT max(q.seq) FROM plan_items q WHERE q.simple_sku = p.simple_sku AND q.gl_month = p.gl_month)""",
)
def last_planned(t: Tables) -> DataFrame:
    return keep_last(t.plan_items, ["simple_sku", "gl_month"], ["seq"]).select(
        "seq", "simple_sku", "gl_month"
    )


@query(
    "win_03",
    """SELECT seq, ean, row_number() OVER (PARTITION BY ean ORDER BY seq) > 1 AS is_repeat FROM plan_items""",
)
def repeats(t: Tables) -> DataFrame:
    return flag_repeats(t.plan_items.select("seq", "ean"), ["ean"], ["seq"])


WIN_04_SQL = f"""
SELECT sku, pos, ref, status, CASE WHEN blanked OR rn = 1 THEN bp_qty END AS bp_qty
FROM (SELECT *, row_number() OVER (PARTITION BY sku, blanked ORDER BY pos, ref, status) AS rn
  FROM (SELECT *, regexp_matches(ref, '{BLANK}') AS blanked FROM bp))
WHERE blanked OR rn = 1 OR status <> 'Draft PO'"""


@query("win_04", WIN_04_SQL)
def attributed(t: Tables) -> DataFrame:
    return attribute_to_first(
        po_line_groups(t.po_lines),
        "sku",
        ["pos", "ref", "status"],
        matches("ref", NOT_FOR_SALE),
        ["bp_qty"],
        F.col("status").eqNullSafe(DRAFT),
    )


@query(
    "win_05",
    "SELECT seq, row_class, config_sku, pos, last_qced, gl_month, dup AS is_repeat FROM vconf",
)
def reduced(t: Tables) -> DataFrame:
    rows = reduce_partial_deliveries(
        inbound(t), "config_sku", "pos", "last_qced", frame_order()
    )
    return rows.select(
        "seq", "row_class", "config_sku", "pos", "last_qced", "gl_month", "is_repeat"
    )


@query(
    "srt_01",
    """SELECT sku, pos, ref, status, bp_qty FROM bp
ORDER BY ref ASC NULLS FIRST, status DESC NULLS FIRST, pos ASC NULLS LAST, sku""",
)
def ordered(t: Tables) -> DataFrame:
    mixed = sort_keys(["ref", "status"], descending=["status"], nulls="first")
    rows = po_line_groups(t.po_lines)
    return rows.orderBy(*mixed, *sort_keys(["pos", "sku"], nulls="last"))


# --- unions and state ------------------------------------------------------------


@query(
    "set_01",
    """SELECT upper(product_id) AS sku, reason, scan_date FROM damage_scans
UNION ALL SELECT upper(sku), NULL, scan_date FROM oversupply_scans""",
)
def stacked(t: Tables) -> DataFrame:
    a = t.damage_scans.select(fold_code("product_id").alias("sku"), "reason", "scan_date")
    b = t.oversupply_scans.select(fold_code("sku").alias("sku"), "scan_date")
    return stack([a, b])


@query(
    "set_02",
    """SELECT upper(product_id) AS sku, scan_date AS date, date_diff('day', DATE '2024-01-10', scan_date) AS age
FROM damage_scans WHERE scan_date >= DATE '2024-01-10'""",
)
def rolled(t: Tables) -> DataFrame:
    scans = t.damage_scans.select(
        fold_code("product_id").alias("sku"), F.col("scan_date").alias("date")
    )
    split = F.lit(date(2024, 1, 18))
    rows = roll_history(
        scans.filter(F.col("date") < split), scans.filter(F.col("date") >= split), SCAN_DAY, 10
    )
    return rows.withColumn("age", F.col("age").cast("long"))


@query(
    "set_03",
    """SELECT product_id, scan_date FROM stock_scans WHERE product_id IS NOT NULL
UNION SELECT product_id, scan_date FROM damage_scans WHERE product_id IS NOT NULL""",
)
def consolidated(t: Tables) -> DataFrame:
    frames = [t.stock_scans, t.damage_scans]
    return consolidate([f.select("product_id", "scan_date") for f in frames], "product_id")


@query("arr_01", f"SELECT seq, piece - 1 AS piece, pos FROM ({PIECES_SQL})")
def exploded(t: Tables) -> DataFrame:
    wide = t.booking_export.select("seq", *kv_fields("additional_fields", BOOKING_FIELDS))
    rows = explode_pieces(wide.select("seq", "pos"), "pos", split_pieces("pos"))
    return rows.select(
        "seq",
        F.col("piece").cast("long").alias("piece"),
        strip_chars("pos", BOOKED_PO_STRIP).alias("pos"),
    )


@query(
    "arr_02",
    """SELECT gl_month, count(*) AS n, CAST(sum(total_units) AS BIGINT) AS units, count(live_date) AS live
FROM plan_items GROUP BY gl_month""",
)
def measures_as_columns(t: Tables) -> DataFrame:
    measures = [F.sum("total_units").alias("units"), *present_counts({"n": "seq", "live": "live_date"})]
    return group_agg(t.plan_items, ["gl_month"], *measures)

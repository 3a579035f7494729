"""The reports, end to end over the driver tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.aggregates import DECILES
from quayside.plans import bookings, compliance, forecast, samples, scans, visibility
from quayside.plans import returns as returns_plan
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
from quayside.registry.elements import (
    BUSDAYS_SQL,
    FLAT_SQL,
    PIECES_SQL,
    STAGE_JOINS,
    STAGES,
    ZONE_SQL,
    ZONED_SQL,
    stage_history,
)
from quayside.sources.adapters import Tables
from quayside.sources.schemas import SAMPLE_STAGES

PARTS["day_first"] = f"""
SELECT * FROM ({PIECES_SQL}) WHERE bdate = DATE '1996-09-30' AND pos IS DISTINCT FROM ''
QUALIFY row_number() OVER (PARTITION BY pos, brand ORDER BY seq, piece) = 1"""
PARTS["last_contact"] = f"""
SELECT pos, client_name, client_email FROM ({PIECES_SQL}) WHERE pos <> ''
QUALIFY row_number() OVER (PARTITION BY pos ORDER BY bdate DESC, seq DESC, piece DESC) = 1"""

# --- inbound and visibility ------------------------------------------------------


@query("pipe_01", "SELECT * REPLACE (round(unit_cost, 4) AS unit_cost, round(total_cost, 4) AS total_cost) FROM inbound")
def inbound_table(t: Tables) -> DataFrame:
    return rounded(inbound(t), 4)


def with_samples(t: Tables) -> DataFrame:
    return visibility.with_samples(inbound(t), t.sample_track)


def master(t: Tables) -> DataFrame:
    return visibility.visibility_master(inbound(t), t.sample_track)


MASTER_SQL = ", ".join(
    f"round({c}, 4) AS {c}" if c in ("unit_cost", "total_cost") else c
    for c in visibility.MASTER_COLUMNS
)
TRACK_SQL = ", ".join(
    f"round({c}, 4) AS {c}" if c in ("unit_cost", "total_cost") else c
    for c in visibility.TRACK_COLUMNS
)


@query("pipe_13", f"SELECT {MASTER_SQL} FROM vis")
def visibility_report(t: Tables) -> DataFrame:
    return rounded(visibility.visibility_master(inbound(t), t.sample_track), 4)


@query("pipe_14", f"SELECT {TRACK_SQL} FROM vis")
def warehouse_track(t: Tables) -> DataFrame:
    return rounded(visibility.warehouse_track(master(t)), 4)


@query(
    "pipe_15",
    f"""SELECT {TRACK_SQL} FROM vis
WHERE date_received IS NOT NULL AND last_qced IS NULL AND last_received IS NULL""",
)
def backlog(t: Tables) -> DataFrame:
    return rounded(visibility.backlog(master(t)), 4)


@query(
    "pipe_16",
    """SELECT gl_month, count(*) FILTER (NOT dup) AS planned, count(*) FILTER (NOT dup AND pos IS NOT NULL) AS on_bp,
  count(*) FILTER (NOT dup AND date_booked IS NOT NULL) AS booked,
  count(*) FILTER (NOT dup AND date_received IS NOT NULL) AS received,
  count(*) FILTER (NOT dup AND last_qced IS NOT NULL) AS qced,
  count(*) FILTER (dup AND last_qced IS NULL) AS partial_delivery,
  count(*) FILTER (NOT dup AND live_date IS NOT NULL) AS live,
  count(*) FILTER (NOT dup AND live_date IS NULL) AS not_live
FROM vconf GROUP BY gl_month""",
)
def config_funnel(t: Tables) -> DataFrame:
    return visibility.config_funnel(inbound(t))


@query(
    "pipe_17",
    """SELECT gl_month, CAST(sum(total_units) AS BIGINT) AS units_planned, CAST(sum(qty_counted) AS BIGINT) AS units_qced,
  CAST(sum(sample_count) AS BIGINT) AS sample_count, CAST(sum(qty_damaged) AS BIGINT) AS qty_damaged,
  CAST(sum(qty_received) AS BIGINT) AS units_taken_in, CAST(sum(qty_putaway) AS BIGINT) AS units_in_wh
FROM vis_sale GROUP BY gl_month""",
)
def units(t: Tables) -> DataFrame:
    return visibility.units_by_month(with_samples(t))


@query(
    "pipe_18",
    """SELECT gl_month, round(n / nullif(n, 0), 6) AS pos_on_bp, round(booked / nullif(n, 0), 6) AS booked,
  round(received / nullif(n, 0), 6) AS received, round(not_received / nullif(n, 0), 6) AS not_received,
  round(partial / nullif(n, 0), 6) AS partial, round(qced / nullif(n, 0), 6) AS qced, round(in_wh / nullif(n, 0), 6) AS in_wh
FROM (SELECT gl_month, count(*) FILTER (NOT dup) AS n,
  count(*) FILTER (NOT dup AND date_booked IS NOT NULL) AS booked,
  count(*) FILTER (NOT dup AND date_received IS NOT NULL) AS received,
  count(*) FILTER (NOT dup AND date_received IS NULL) AS not_received,
  count(*) FILTER (dup AND last_qced IS NULL) AS partial,
  count(*) FILTER (NOT dup AND last_qced IS NOT NULL) AS qced,
  count(*) FILTER (NOT dup AND last_received IS NOT NULL) AS in_wh
  FROM pocount GROUP BY gl_month)""",
)
def po_progress(t: Tables) -> DataFrame:
    return rounded(visibility.po_progress(with_samples(t)))


@query(
    "pipe_19",
    """SELECT gl_month, round(a, 2) AS not_on_bp, round(b - a, 2) AS not_booked_not_delivered,
  round(c - (a + (b - a)), 2) AS booked_not_delivered, round(d - (a + (b - a) + (c - b)), 2) AS partial_delivery
FROM (SELECT gl_month, sum(CASE WHEN status IS NULL THEN unit_cost * total_units END) AS a,
  sum(CASE WHEN date_received IS NULL AND date_booked IS NULL THEN unit_cost * total_units END) AS b,
  sum(CASE WHEN date_received IS NULL THEN unit_cost * total_units END) AS c,
  sum(CASE WHEN last_qced IS NULL THEN unit_cost * total_units END) AS d,
  count(CASE WHEN status IS NULL OR date_received IS NULL OR last_qced IS NULL THEN 1 END) AS n
  FROM vis_sale GROUP BY gl_month) WHERE n > 0""",
)
def working_capital(t: Tables) -> DataFrame:
    return rounded(visibility.working_capital(with_samples(t)), 2)


FUNNEL_SQL = """count(config_sku) AS planned, count(pos) AS on_bp, count(date_booked) AS booked,
  count(date_received) AS received, count(last_qced) AS qced, count(live_date) AS live"""
WEEK_SQL = "gl_date - CAST(isodow(gl_date) - 3 AS INTEGER)"


@query("pipe_20", f"SELECT {WEEK_SQL} AS gl_week, {FUNNEL_SQL} FROM vconf GROUP BY 1")
def config_weeks(t: Tables) -> DataFrame:
    return visibility.config_weeks(inbound(t))


PO_TRACK_SQL = """count(*) FILTER (NOT dup) AS po_total,
  count(*) FILTER (NOT dup AND status = 'Draft PO') AS po_draft,
  count(*) FILTER (NOT dup AND date_received IS NOT NULL) AS po_received,
  count(*) FILTER (NOT dup AND date_received IS NULL) AS not_received FROM potrack"""


@query("pipe_21", f"SELECT gl_month, gl_day, {PO_TRACK_SQL} GROUP BY gl_month, gl_day")
def po_summary(t: Tables) -> DataFrame:
    return visibility.po_summary(with_samples(t))


@query(
    "pipe_22",
    f"SELECT buyer, gl_month, gl_day, {PO_TRACK_SQL} WHERE buyer IS NOT NULL GROUP BY buyer, gl_month, gl_day",
)
def po_summary_per_buyer(t: Tables) -> DataFrame:
    return visibility.po_summary_per_buyer(with_samples(t))


# --- compliance ------------------------------------------------------------------


def compliance_sql(keys: str, where: str = "true") -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"""SELECT {keys}, round(sum(c), 2) AS total_cost, count(*) AS pos, CAST(sum(u) AS BIGINT) AS total_units,
  round(avg(mb), 6) AS missed_booking_days, round((count(*) - count(mb)) / count(*), 6) AS not_booked,
  round(avg(mp), 6) AS missed_plan_days, round((count(*) - count(mp)) / count(*), 6) AS not_delivered,
  round(abs(sum(q) / nullif(sum(u), 0)), 6) AS in_full, CAST(sum(d) AS BIGINT) AS qty_damaged
FROM (SELECT {keys}, pos, sum(total_units) AS u, sum(total_cost) AS c, sum(qty_counted) AS q, sum(qty_damaged) AS d,
    avg(abs(date_received - date_booked)) AS mb, avg(abs(delivery_due - date_received)) AS mp
  FROM inbound
  WHERE (ref IS NULL OR NOT regexp_matches(ref, '{BLANK}')) AND status <> 'Draft PO'
    AND (total_units IS NULL OR total_units <> 0) AND pos IS NOT NULL AND {present}
  GROUP BY {keys}, pos)
WHERE {where} GROUP BY {keys}"""


@query(
    "pipe_23",
    f"""SELECT 'all' AS tab, * FROM ({compliance_sql("gl_month, supplier")})
UNION ALL SELECT 'last month', * FROM ({compliance_sql("gl_month, supplier", "gl_month = 2")})""",
)
def supplier_compliance(t: Tables) -> DataFrame:
    return _with_last_month(compliance.supplier_compliance(inbound(t)))


@query(
    "pipe_24",
    f"""SELECT 'all' AS tab, * FROM ({compliance_sql("gl_month, buyer")})
UNION ALL SELECT 'last month', * FROM ({compliance_sql("gl_month, buyer", "gl_month = 2")})""",
)
def buyer_compliance(t: Tables) -> DataFrame:
    return _with_last_month(compliance.buyer_compliance(inbound(t)))


def _with_last_month(monthly: DataFrame) -> DataFrame:
    """Both tabs of the report: a row of the last month appears in each, from one computation."""
    in_last = F.col("gl_month") == compliance.last_month_number(AS_OF)
    tabs = F.when(in_last, F.array(F.lit("all"), F.lit("last month"))).otherwise(
        F.array(F.lit("all"))
    )
    return rounded(monthly.withColumn("tab", F.explode(tabs)), total_cost=2)


@query("pipe_25", compliance_sql("buyer"))
def buyer_compliance_period(t: Tables) -> DataFrame:
    return rounded(compliance.buyer_compliance_period(inbound(t)), total_cost=2)


# --- forecast and go-live --------------------------------------------------------

DUE_WEEKS_SQL = f"""(SELECT *, due - CAST(isodow(due) - 3 AS INTEGER) AS delivery_week FROM (
  SELECT *, CASE WHEN delivery_due IS NULL THEN gl_date - 14 ELSE delivery_due END AS due FROM inbound_wide
  WHERE (ref IS NULL OR NOT regexp_matches(ref, '{BLANK}')) AND procurement_status IS DISTINCT FROM 'Deleted'))
WHERE delivery_week >= DATE '1997-01-01' AND delivery_week < DATE '1997-06-01'"""


def delivery_weeks(t: Tables) -> DataFrame:
    return forecast.delivery_weeks(inbound(t, 2, 2), AS_OF)


@query(
    "pipe_26",
    f"""SELECT delivery_week, CAST(sum(total_units) AS BIGINT) AS qty_planned,
  CAST(sum(qty_received) AS BIGINT) AS qty_received FROM {DUE_WEEKS_SQL} GROUP BY delivery_week""",
)
def weekly_forecast(t: Tables) -> DataFrame:
    return forecast.weekly_forecast(delivery_weeks(t))


WEEK_COLUMNS_SQL = ", ".join(
    f"CAST(sum(total_units) FILTER (delivery_week = DATE '{w}') AS BIGINT) AS \"{w}\""
    for w in forecast.weeks_in_window(AS_OF)
)


@query(
    "pipe_27",
    f"""SELECT CASE WHEN grouping(category) = 1 THEN 'All' ELSE category END AS category, {WEEK_COLUMNS_SQL},
  CAST(sum(total_units) AS BIGINT) AS "All" FROM {DUE_WEEKS_SQL} AND category IS NOT NULL
GROUP BY ROLLUP (category)""",
)
def unit_plan(t: Tables) -> DataFrame:
    return forecast.unit_plan(delivery_weeks(t), AS_OF)


GL_FIRST_SQL = """(SELECT * FROM inbound_gl QUALIFY row_number() OVER (PARTITION BY config_sku ORDER BY
  row_class, seq, pos ASC NULLS LAST, ref ASC NULLS FIRST, status ASC NULLS FIRST, delivery_due ASC NULLS LAST) = 1)"""


@query(
    "pipe_28",
    f"""SELECT 'week' AS tab, CAST({WEEK_SQL} AS VARCHAR) AS period, {FUNNEL_SQL} FROM {GL_FIRST_SQL} GROUP BY 1, 2
UNION ALL SELECT 'month', CAST(gl_month AS VARCHAR), {FUNNEL_SQL} FROM {GL_FIRST_SQL} GROUP BY 1, 2""",
)
def go_live(t: Tables) -> DataFrame:
    rows = inbound(t, back=AS_OF.month - 2, fwd=6 - AS_OF.month)
    return visibility.go_live_track(rows)


# --- bookings --------------------------------------------------------------------


@query(
    "pipe_02",
    f"""SELECT strftime(bdate, '%Y/%m/%d') AS bdate, '08:00' AS btime, event, coalesce(pos, '-') AS pos,
  CASE WHEN (SELECT count(DISTINCT event) FROM day_first) > 1 AND event = 'Merchant Delivery' THEN brand
    ELSE supplier END AS supplier, brand, boxes, partial_delivery FROM day_first""",
)
def receiving_report(t: Tables) -> DataFrame:
    return bookings.receiving_report(t.booking_export, BOOKING_DAY)


@query(
    "pipe_03",
    f"""SELECT seq, piece - 1 AS piece, bdate AS date, event, pos, supplier, brand, client_name, client_email,
  CAST(bdate - DATE '1996-07-19' AS BIGINT) AS age FROM ({PIECES_SQL}) WHERE bdate >= DATE '1996-07-19'""",
)
def contacts(t: Tables) -> DataFrame:
    """History up to a week before the day, new bookings after it."""
    cut = F.lit(BOOKING_DAY - timedelta(days=7))
    past = bookings.contact_rows(t.booking_export.filter(F.col("bdate") <= cut))
    new = t.booking_export.filter(F.col("bdate") > cut)
    rows = bookings.rolling_contacts(past, new, BOOKING_DAY)
    return rows.withColumns({c: F.col(c).cast("long") for c in ("piece", "age")})


# --- scans -----------------------------------------------------------------------


@query(
    "pipe_04",
    """SELECT DISTINCT DATE '2024-01-31' AS date, l.pos AS po, l.status, l.ref, l.contact AS supplier,
  l.bp_qty AS qty_ordered, c.n AS qty_counted, c.n - l.bp_qty AS qty_diff, c.product_id, l.name AS description,
  p.category, 'A' AS team
FROM (SELECT upper(product_id) AS product_id, count(*) AS n FROM stock_scans GROUP BY 1) c
LEFT JOIN po_lines l ON l.sku = c.product_id
LEFT JOIN (SELECT DISTINCT simple_sku, category FROM plan_items) p ON p.simple_sku = c.product_id""",
)
def shift_count(t: Tables) -> DataFrame:
    return scans.shift_count(t.stock_scans, t.po_lines, t.plan_items, SHIFT, "A")


def known_contacts(t: Tables) -> DataFrame:
    return bookings.contact_rows(t.booking_export)


DAILY_SQL = f"""SELECT DATE '2024-01-20' AS date, l.contact AS supplier, l.pos AS po, m.sku, l.name AS description,
  m.reason, m.damaged, m.oversupply, k.client_name, k.client_email
FROM (SELECT coalesce(o.sku, d.sku) AS sku, reason, damaged, oversupply
  FROM (SELECT upper(product_id) AS sku, reason, count(*) AS damaged FROM damage_scans GROUP BY 1, 2) d
  FULL JOIN (SELECT upper(sku) AS sku, count(*) AS oversupply FROM oversupply_scans GROUP BY 1) o ON d.sku = o.sku) m
LEFT JOIN po_lines l ON l.sku = m.sku LEFT JOIN last_contact k ON k.pos = l.pos"""


@query("pipe_06", DAILY_SQL)
def daily_damages(t: Tables) -> DataFrame:
    return scans.daily_damages(
        t.damage_scans, t.oversupply_scans, t.po_lines, known_contacts(t), SCAN_DAY
    )


@query(
    "pipe_07",
    """SELECT d.scan_date AS date, l.pos, upper(d.product_id) AS sku, d.reason, d.responsible
FROM damage_scans d LEFT JOIN po_lines l ON l.sku = upper(d.product_id)""",
)
def rolling_damages(t: Tables) -> DataFrame:
    return scans.rolling_damages(t.damage_scans, t.po_lines)


@query(
    "pipe_08",
    f"SELECT date, supplier, po, sku, oversupply FROM ({DAILY_SQL}) WHERE oversupply IS NOT NULL",
)
def rolling_oversupply(t: Tables) -> DataFrame:
    return scans.rolling_oversupply(t.damage_scans, t.oversupply_scans, t.po_lines, SCAN_DAY)


@query(
    "pipe_09",
    """SELECT DATE '1996-09-27' AS date, p.supplier_name AS supplier, p.purchase_order_number AS po, m.simple_sku,
  p.simple_name AS description, m.brand_name, m.damaged, m.oversupply, k.client_name, k.client_email
FROM (SELECT coalesce(o.sku, i.simple_sku) AS simple_sku, brand_name, qc_bad_qty AS damaged, oversupply
  FROM (SELECT * FROM inventory WHERE inv_date = DATE '1996-09-27') i
  FULL JOIN (SELECT upper(sku) AS sku, count(*) AS oversupply FROM oversupply_scans GROUP BY 1) o
  ON o.sku = i.simple_sku) m
LEFT JOIN po_items p ON p.simple_sku = m.simple_sku LEFT JOIN last_contact k ON k.pos = p.purchase_order_number""",
)
def bad_stock(t: Tables) -> DataFrame:
    return scans.bad_stock(
        t.inventory, t.oversupply_scans, t.po_items, known_contacts(t), BOOKING_DAY
    )


# --- samples ---------------------------------------------------------------------


def counted_checks(t: Tables) -> DataFrame:
    return t.qc_counts.select(
        F.col("sku").alias("simple_sku"), "qc_date", F.lit(None).cast("long").alias("qc_count")
    )


def inventory_checks(t: Tables) -> DataFrame:
    return t.inventory.select(
        "simple_sku", F.col("inv_date").alias("qc_date"), F.col("qc_good_qty").alias("qc_count")
    )


def trail(t: Tables, checks: DataFrame, with_qc_count: bool = False) -> DataFrame:
    plan = samples.sample_plan(t.plan_items, checks, AS_OF)
    stages = samples.last_stages(samples.stage_rows(*stage_history(t), SHIFT))
    return samples.sample_trail(plan, stages, with_qc_count)


def trail_sql(checks: str, columns: str) -> str:
    """The literal steps: join every check, keep the last per config, chain six outer joins."""
    falling = ", ".join(f"{s} DESC NULLS LAST" for s in SAMPLE_STAGES[1:])
    return f"""SELECT gl_day, gl_month, gl_year, config_sku, sku, config_name, supplier, designer, category, buyer,
  {columns}, {STAGES}
FROM (
  SELECT * FROM (
    SELECT p.*, q.qc_date, q.qc_count FROM (
      SELECT * FROM plan_items QUALIFY row_number() OVER (PARTITION BY simple_sku, gl_month ORDER BY seq DESC) = 1
    ) p LEFT JOIN ({checks}) q USING (simple_sku) WHERE total_cost > 0
    QUALIFY row_number() OVER (PARTITION BY config_sku ORDER BY seq DESC, qc_date DESC NULLS LAST, qc_count DESC NULLS LAST) = 1
  ) WHERE gl_year * 12 + gl_month BETWEEN 1997 * 12 + 1 AND 1997 * 12 + 5
) plan
FULL JOIN (
  SELECT *, CASE WHEN length(sku) = 11 THEN left(sku, 7) ELSE sku END AS config_sku FROM {STAGE_JOINS}
) st USING (config_sku)
QUALIFY row_number() OVER (PARTITION BY config_sku, {SAMPLE_STAGES[0]} ORDER BY sku DESC NULLS LAST, {falling}) = 1"""


COUNTED_SQL = "SELECT sku AS simple_sku, qc_date, CAST(NULL AS BIGINT) AS qc_count FROM qc_counts"
INVENTORY_SQL = "SELECT simple_sku, inv_date AS qc_date, qc_good_qty AS qc_count FROM inventory"


@query("pipe_10", trail_sql(COUNTED_SQL, "qc_date"))
def sample_trail(t: Tables) -> DataFrame:
    return trail(t, counted_checks(t))


@query("pipe_11", trail_sql(INVENTORY_SQL, "qc_date, qc_count"))
def sample_trail_counted(t: Tables) -> DataFrame:
    return trail(t, inventory_checks(t), with_qc_count=True)


@query(
    "pipe_12",
    f"""SELECT gl_year, gl_month, count(qc_date) AS qc_date, {", ".join(f"count({s}) AS {s}" for s in SAMPLE_STAGES)}
FROM ({trail_sql(COUNTED_SQL, "qc_date")}) WHERE gl_year IS NOT NULL GROUP BY gl_year, gl_month""",
)
def sample_summary(t: Tables) -> DataFrame:
    return samples.sample_summary(trail(t, counted_checks(t)))


# --- returns ---------------------------------------------------------------------

RETURNS_SQL = f"""(SELECT s.*, CASE WHEN d.delay >= 0 THEN d.delay END AS delay FROM shipments s
  LEFT JOIN (SELECT poh_date, pod_date, {BUSDAYS_SQL} AS delay FROM (SELECT DISTINCT poh_date, pod_date FROM shipments)) d
    ON d.poh_date = s.poh_date AND d.pod_date = s.pod_date
  WHERE s.shipment_id LIKE 'SPR%' OR s.shipment_id LIKE 'COL%')"""


def summary_sql(name: str, c: str, source: str) -> str:
    return f"""SELECT '{name}' AS measure, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS p25,
  round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS p50, round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS p75,
  round(CAST(max({c}) AS DOUBLE), 6) AS max, round(CAST(sum({c}) AS DOUBLE), 2) AS total FROM {source}"""


@query(
    "pipe_29",
    f"""{summary_sql("charge_out", "charge_out", RETURNS_SQL)} WHERE charge_out > 0
UNION ALL {summary_sql("delay", "delay", RETURNS_SQL)} WHERE charge_out > 0""",
)
def collection_delay(t: Tables) -> DataFrame:
    return rounded(returns_plan.collection_summary(t.shipments), total=2)


@query(
    "pipe_30",
    summary_sql(
        "post_office_charge", "charge", f"(SELECT CAST({FLAT_SQL} AS DOUBLE) AS charge FROM {RETURNS_SQL})"
    ),
)
def post_office(t: Tables) -> DataFrame:
    return rounded(returns_plan.post_office_summary(t.shipments), total=2)


@query(
    "pipe_31",
    summary_sql(
        "counter_charge", "charge", f"(SELECT CAST({ZONED_SQL} AS DOUBLE) AS charge FROM {RETURNS_SQL})"
    ),
)
def counter(t: Tables) -> DataFrame:
    return rounded(returns_plan.counter_summary(t.shipments), total=2)


SLA_SQL = f"""(SELECT *, {ZONE_SQL} AS sla_zone, month(poh_date) AS m FROM {RETURNS_SQL}
  WHERE charge_out > 0 AND month(poh_date) < 12)"""
DECILE_SQL = ", ".join(
    f"round(CAST(quantile_cont(delay, {q}) AS DOUBLE), 6) AS p{round(q * 100)}" for q in DECILES
)
STATS_SQL = f"""CAST(count(delay) AS DOUBLE) AS n, round(avg(delay), 6) AS mean, round(stddev_samp(delay), 6) AS std,
  CAST(min(delay) AS DOUBLE) AS min, {DECILE_SQL}, CAST(max(delay) AS DOUBLE) AS max"""


@query(
    "pipe_32",
    f"""SELECT sla_zone, {STATS_SQL.replace("CAST(count(delay) AS DOUBLE) AS n", "count(delay) AS n")}
FROM {SLA_SQL} WHERE delay IS NOT NULL AND sla_zone IS NOT NULL GROUP BY sla_zone""",
)
def collected(t: Tables) -> DataFrame:
    return rounded(returns_plan.collected_by_zone(returns_plan.sla_rows(t.shipments)))


@query(
    "pipe_33",
    f"SELECT sla_zone, count(*) AS n FROM {SLA_SQL} WHERE delay IS NULL AND sla_zone IS NOT NULL GROUP BY sla_zone",
)
def not_collected(t: Tables) -> DataFrame:
    return returns_plan.not_collected_by_zone(returns_plan.sla_rows(t.shipments))


MONTH_COLUMNS_SQL = ", ".join(f"max(CASE WHEN m = {m} THEN value END) AS m{m}" for m in range(1, 12))


@query(
    "pipe_34",
    f"""SELECT sla_zone, statistic, {MONTH_COLUMNS_SQL} FROM (
  UNPIVOT (SELECT sla_zone, m, {STATS_SQL} FROM {SLA_SQL} WHERE delay IS NOT NULL AND sla_zone IS NOT NULL GROUP BY sla_zone, m)
  ON COLUMNS(* EXCLUDE (sla_zone, m)) INTO NAME statistic VALUE value)
GROUP BY sla_zone, statistic""",
)
def collected_by_month(t: Tables) -> DataFrame:
    return rounded(returns_plan.collected_by_month(returns_plan.sla_rows(t.shipments)))


@query(
    "pipe_35",
    "SELECT sla_zone, "
    + ", ".join(f"nullif(count(CASE WHEN m = {m} THEN 1 END), 0) AS m{m}" for m in range(1, 12))
    + f" FROM {SLA_SQL} WHERE delay IS NULL AND sla_zone IS NOT NULL GROUP BY sla_zone",
)
def not_collected_by_month(t: Tables) -> DataFrame:
    return returns_plan.not_collected_by_month(returns_plan.sla_rows(t.shipments))

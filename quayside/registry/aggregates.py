"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import iso_week_day
from quayside.operators.aggregates import (
    DECILES,
    QUARTILES,
    conditional_counts,
    group_agg,
    in_full,
    margins_pivot,
    missing_share,
    present_counts,
    scale_by_first,
    unstack,
    value_counts,
    waterfall,
)
from quayside.operators.quantiles import describe_spread
from quayside.operators.reshape import stage_pairs
from quayside.plans import inbound as inbound_plan
from quayside.plans.bookings import several_events
from quayside.plans.scans import plan_categories, scan_counts
from quayside.plans.visibility import FUNNEL
from quayside.registry.core import inbound, query, rounded
from quayside.registry.storage import STAGE_ROW
from quayside.sources.adapters import Tables
from quayside.sources.schemas import SAMPLE_STAGES


@query(
    "agg_01",
    """SELECT sku, pos, ref, status, CAST(sum(bp_qty) AS BIGINT) AS bp_qty FROM po_lines
WHERE ref IS NOT NULL AND status NOT LIKE '%Cancel PO%' GROUP BY ALL""",
)
def grouped_sum(t: Tables) -> DataFrame:
    return inbound_plan.po_line_groups(t.po_lines)


@query("agg_02", "SELECT pos, sku, qty_counted, last_qced FROM qced")
def sum_and_max(t: Tables) -> DataFrame:
    return group_agg(
        t.qc_counts,
        ["pos", "sku"],
        F.sum("qty_counted").alias("qty_counted"),
        F.max("qc_date").alias("last_qced"),
    )


@query(
    "agg_03",
    """SELECT upper(product_id) AS product_id, reason, count(*) AS damaged FROM damage_scans GROUP BY 1, 2""",
)
def row_counts(t: Tables) -> DataFrame:
    return scan_counts(t.damage_scans, "product_id", "damaged", "reason")


@query("agg_04", "SELECT ref, count(ref) AS n FROM po_lines WHERE ref IS NOT NULL GROUP BY ref")
def counted_values(t: Tables) -> DataFrame:
    return value_counts(t.po_lines, "ref")


FUNNEL_SQL = """count(config_sku) AS planned, count(pos) AS on_bp, count(date_booked) AS booked,
  count(date_received) AS received, count(last_qced) AS qced, count(live_date) AS live"""


@query(
    "agg_05a",
    f"""SELECT gl_date - CAST(isodow(gl_date) - 3 AS INTEGER) AS gl_week, {FUNNEL_SQL} FROM inbound GROUP BY 1""",
)
def funnel_by_week(t: Tables) -> DataFrame:
    rows = inbound(t).withColumn("gl_week", iso_week_day("gl_date"))
    return group_agg(rows, ["gl_week"], *present_counts(FUNNEL))


@query("agg_05b", f"SELECT gl_month, {FUNNEL_SQL} FROM inbound GROUP BY gl_month")
def funnel_by_month(t: Tables) -> DataFrame:
    return group_agg(inbound(t), ["gl_month"], *present_counts(FUNNEL))


@query(
    "agg_05c",
    "SELECT pos, count(sku) AS n_skus FROM po_lines WHERE status = 'Cancel PO' GROUP BY pos",
)
def cancelled(t: Tables) -> DataFrame:
    return inbound_plan.cancelled_orders(t.po_lines)


@query(
    "agg_05d",
    f"""SELECT CAST(year(scan_date) AS INT) AS year, CAST(month(scan_date) AS INT) AS month,
  {", ".join(f"count(CASE WHEN stage = {i} THEN 1 END) AS {s}" for i, s in enumerate(SAMPLE_STAGES, 1))}
FROM stage_scans GROUP BY 1, 2""",
)
def stage_counts(t: Tables) -> DataFrame:
    wide = t.stage_scans.selectExpr(
        "year(scan_date) AS year", "month(scan_date) AS month", *STAGE_ROW.split(", ")
    )
    return group_agg(wide, ["year", "month"], *present_counts({s: s for s in SAMPLE_STAGES}))


@query(
    "agg_06",
    """SELECT buyer, gl_month, CAST(sum(CASE WHEN pos IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS on_bp,
  CAST(sum(CASE WHEN status = 'Draft PO' THEN 1 ELSE 0 END) AS BIGINT) AS draft,
  CAST(sum(CASE WHEN date_received IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS not_received
FROM inbound WHERE buyer IS NOT NULL AND gl_month IS NOT NULL GROUP BY buyer, gl_month""",
)
def conditional(t: Tables) -> DataFrame:
    measures = {
        "on_bp": F.col("pos").isNotNull(),
        "draft": F.col("status") == "Draft PO",
        "not_received": F.col("date_received").isNull(),
    }
    return group_agg(inbound(t), ["buyer", "gl_month"], *conditional_counts(measures))


@query(
    "agg_07",
    """SELECT contact, count(*) AS pos, CAST(sum(q) AS BIGINT) AS qty, round(avg(a), 6) AS mean_qty FROM (
  SELECT contact, pos, sum(bp_qty) AS q, avg(bp_qty) AS a FROM po_lines GROUP BY contact, pos)
GROUP BY contact""",
)
def two_level(t: Tables) -> DataFrame:
    per_po = group_agg(
        t.po_lines, ["contact", "pos"], F.sum("bp_qty").alias("q"), F.avg("bp_qty").alias("a")
    )
    return rounded(
        group_agg(
            per_po,
            ["contact"],
            F.count(F.lit(1)).alias("pos"),
            F.sum("q").alias("qty"),
            F.avg("a").alias("mean_qty"),
        )
    )


@query(
    "agg_08",
    """SELECT supplier, round(1.0 - count(date_booked) / count(*), 6) AS not_booked,
  round(1.0 - count(date_received) / count(*), 6) AS not_delivered FROM inbound WHERE supplier IS NOT NULL GROUP BY supplier""",
)
def shares(t: Tables) -> DataFrame:
    return rounded(
        group_agg(
            inbound(t),
            ["supplier"],
            missing_share("date_booked").alias("not_booked"),
            missing_share("date_received").alias("not_delivered"),
        )
    )


@query(
    "agg_09",
    """SELECT supplier, round(abs(sum(qty_counted) / nullif(sum(total_units), 0)), 6) AS in_full
FROM inbound WHERE supplier IS NOT NULL GROUP BY supplier""",
)
def in_full_share(t: Tables) -> DataFrame:
    return rounded(
        group_agg(
            inbound(t),
            ["supplier"],
            in_full(F.sum("qty_counted"), F.sum("total_units")).alias("in_full"),
        )
    )


@query(
    "agg_10",
    """SELECT category, CAST(a AS BIGINT) AS no_status, CAST(b - a AS BIGINT) AS unbooked,
  CAST(c - (a + (b - a)) AS BIGINT) AS undelivered
FROM (SELECT category, sum(CASE WHEN status IS NULL THEN total_units END) AS a,
  sum(CASE WHEN date_booked IS NULL AND date_received IS NULL THEN total_units END) AS b,
  sum(CASE WHEN date_received IS NULL THEN total_units END) AS c,
  count(CASE WHEN status IS NULL OR date_received IS NULL THEN 1 END) AS n
  FROM inbound GROUP BY category) WHERE n > 0""",
)
def staged_sums(t: Tables) -> DataFrame:
    stages = {
        "no_status": F.col("status").isNull(),
        "unbooked": F.col("date_booked").isNull() & F.col("date_received").isNull(),
        "undelivered": F.col("date_received").isNull(),
    }
    return waterfall(inbound(t), ["category"], F.col("total_units"), stages)


@query(
    "agg_11",
    """SELECT gl_month, CAST(sum(total_units) AS BIGINT) AS units, round(sum(total_cost), 4) AS cost
FROM plan_items GROUP BY gl_month ORDER BY gl_month""",
)
def monthly_sums(t: Tables) -> DataFrame:
    sums = [F.sum("total_units").alias("units"), F.sum("total_cost").alias("cost")]
    return rounded(group_agg(t.plan_items, ["gl_month"], *sums), 4).orderBy("gl_month")


@query(
    "agg_12",
    """SELECT count(charge_out) AS n, round(avg(charge_out), 6) AS mean, round(stddev_samp(charge_out), 6) AS std,
  round(min(charge_out), 6) AS min, round(quantile_cont(charge_out, 0.25), 6) AS p25,
  round(quantile_cont(charge_out, 0.5), 6) AS p50, round(quantile_cont(charge_out, 0.75), 6) AS p75,
  round(max(charge_out), 6) AS max, round(sum(charge_out), 4) AS total
FROM shipments WHERE charge_out > 0""",
)
def described(t: Tables) -> DataFrame:
    names = {f"p{round(q * 100)}": q for q in QUARTILES}
    charged = t.shipments.filter(F.col("charge_out") > 0)
    return rounded(describe_spread(charged, [], "charge_out", names, total="total"), total=4)


DECILE_SQL = ", ".join(
    f"round(CAST(quantile_cont({{0}}, {q}) AS DOUBLE), 6) AS p{round(q * 100)}" for q in DECILES
)


@query(
    "agg_13",
    f"""SELECT zone, count(chargeable_mass) AS n, round(avg(chargeable_mass), 6) AS mean,
  round(stddev_samp(chargeable_mass), 6) AS std, min(chargeable_mass) AS min,
  {DECILE_SQL.format("chargeable_mass")}, max(chargeable_mass) AS max
FROM shipments WHERE zone IS NOT NULL GROUP BY zone""",
)
def described_by_zone(t: Tables) -> DataFrame:
    names = {f"p{round(q * 100)}": q for q in DECILES}
    return rounded(describe_spread(t.shipments, ["zone"], "chargeable_mass", names))


@query(
    "agg_14",
    """SELECT zone, count(*) AS n FROM shipments WHERE pod_date IS NULL AND zone IS NOT NULL GROUP BY zone""",
)
def open_by_zone(t: Tables) -> DataFrame:
    open_rows = t.shipments.filter(F.col("pod_date").isNull())
    return group_agg(open_rows, ["zone"], F.count(F.lit(1)).alias("n"))


STATUSES = ("Cancel PO", "Draft PO", "Placed")


@query(
    "agg_15",
    """SELECT coalesce(contact, 'All') AS contact, CAST(sum(bp_qty) FILTER (status = 'Cancel PO') AS BIGINT) AS "Cancel PO",
  CAST(sum(bp_qty) FILTER (status = 'Draft PO') AS BIGINT) AS "Draft PO",
  CAST(sum(bp_qty) FILTER (status = 'Placed') AS BIGINT) AS "Placed", CAST(sum(bp_qty) AS BIGINT) AS "All"
FROM po_lines WHERE status IS NOT NULL GROUP BY ROLLUP (contact)""",
)
def with_margins(t: Tables) -> DataFrame:
    return margins_pivot(t.po_lines, "contact", "status", STATUSES, "bp_qty")


@query(
    "agg_16",
    "SELECT zone, "
    + ", ".join(
        f"nullif(count(CASE WHEN month(poh_date) = {m} THEN 1 END), 0) AS m{m}" for m in range(1, 12)
    )
    + " FROM shipments WHERE zone IS NOT NULL AND month(poh_date) < 12 GROUP BY zone",
)
def unstacked(t: Tables) -> DataFrame:
    rows = t.shipments.withColumn("month", F.month("poh_date")).filter(F.col("month") < 12)
    months = list(range(1, 12))
    wide = unstack(rows, ["zone"], "month", months, F.count(F.lit(1)))
    return wide.withColumnsRenamed({str(m): f"m{m}" for m in months})


@query("agg_17", "SELECT simple_sku AS product_id, category FROM plan_items GROUP BY ALL")
def whole_rows(t: Tables) -> DataFrame:
    return plan_categories(t.plan_items)


@query(
    "agg_18",
    " UNION ALL ".join(
        f"SELECT '{s}' AS stage, sku, scan_date FROM stage_scans WHERE stage = {i} GROUP BY sku, scan_date"
        for i, s in enumerate(SAMPLE_STAGES, 1)
    ),
)
def distinct_pairs(t: Tables) -> DataFrame:
    wide = t.stage_scans.selectExpr("sku", *STAGE_ROW.split(", "))
    return stage_pairs(wide, "sku", SAMPLE_STAGES, value="scan_date")


@query(
    "agg_19",
    """SELECT contact, CASE WHEN n = 0 THEN NULL ELSE CAST(1 AS DOUBLE) END AS n, round(r / n, 6) AS with_ref, round(s / n, 6) AS with_status
FROM (SELECT contact, CAST(count(*) AS DOUBLE) AS n, count(ref) AS r, count(status) AS s FROM po_lines GROUP BY contact)""",
)
def scaled(t: Tables) -> DataFrame:
    counts = group_agg(
        t.po_lines,
        ["contact"],
        F.count(F.lit(1)).alias("n"),
        F.count("ref").alias("with_ref"),
        F.count("status").alias("with_status"),
    )
    return rounded(scale_by_first(counts, ["n", "with_ref", "with_status"]))


@query(
    "agg_20",
    """SELECT bdate, event, (SELECT count(DISTINCT event) > 1 FROM booking_export) AS several
FROM booking_export GROUP BY bdate, event""",
)
def distinct_values(t: Tables) -> DataFrame:
    days = t.booking_export.select("bdate", "event").distinct()
    return days.withColumn("several", several_events(t.booking_export))


@query(
    "agg_21",
    """SELECT gl_date - CAST(isodow(gl_date) - 3 AS INTEGER) AS week, CAST(sum(total_units) AS BIGINT) AS qty_planned,
  CAST(sum(qty_received) AS BIGINT) AS qty_received FROM inbound GROUP BY 1""",
)
def planned_and_received(t: Tables) -> DataFrame:
    rows = inbound(t).withColumn("week", iso_week_day("gl_date"))
    return group_agg(
        rows,
        ["week"],
        F.sum("total_units").alias("qty_planned"),
        F.sum("qty_received").alias("qty_received"),
    )

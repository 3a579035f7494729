"""How the jobs keep and read their state, end to end over the driver tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.membership import consolidated
from quayside.operators.quantiles import describe_spread
from quayside.plans import compliance, incremental, nightly, samples, scans, visibility
from quayside.plans.inbound import inbound_data
from quayside.registry.aggregates import DECILE_SQL
from quayside.registry.core import AS_OF, SHIFT, inbound, inbound_sources, query, rounded
from quayside.registry.elements import stage_history
from quayside.registry.reports import DAILY_SQL, INVENTORY_SQL, MASTER_SQL, compliance_sql, inventory_checks, trail_sql
from quayside.session import scratch_path
from quayside.sources import schemas
from quayside.sources.adapters import Tables
from quayside.sources.colocated import Layout, nightly_line_facts, write_nightly
from quayside.sources.history import read_checked_history
from quayside.sources.keyed import KeyedState
from quayside.sources.sinks import materialize, write_ordered

# Names of these queries: mechanism, not inventory.
MECHANISMS = (
    "spread_quantiles",
    "sample_state",
    "scan_chain_stock",
    "scan_chain_damages",
    "scan_chain_oversupply",
    "checked_history",
    "incremental_history",
    "colocated_lines",
    "incremental_inbound",
    "compliance_one_pass",
    "ordered_master",
)


@query(
    "spread_quantiles",
    f"""SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean,
  round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
  {DECILE_SQL.format("l_extendedprice")}, max(l_extendedprice) AS max
FROM lineitem GROUP BY l_returnflag""",
)
def spread(t: Tables) -> DataFrame:
    """Deciles of free amounts, nearly all different, in few groups."""
    names = {f"p{round(q * 100)}": q for q in (i / 10 for i in range(1, 11))}
    return rounded(describe_spread(t.driver("lineitem"), ["l_returnflag"], "l_extendedprice", names), std=4)


@query("sample_state", trail_sql(INVENTORY_SQL, "qc_date, qc_count"))
def sample_days(t: Tables) -> DataFrame:
    """The trail after the history came in three parts, the last with the new scans, and a rerun of it."""
    history, new = stage_history(t)
    state = KeyedState(t.spark, scratch_path(t.spark, "sample-state"), nightly.SAMPLE_STATE, "sku", 16)
    reduced = samples.reduced_history(history).select("sku", *schemas.SAMPLE_STAGES)
    reduced = materialize(reduced, scratch_path(t.spark, "sample-history"))
    half = F.pmod(F.xxhash64(*schemas.SAMPLE_STAGES), F.lit(2)) == 0
    stamped = samples.stamped_stages(new, SHIFT)
    for part in (reduced.filter(half), reduced.filter(~half), stamped, stamped):
        state.upsert(part, samples.item_stages)
    plan = samples.sample_plan(t.plan_items, inventory_checks(t), AS_OF)
    return samples.sample_trail(plan, samples.last_stages(state.read()), True)


def _inbox(t: Tables, name: str, sheet: DataFrame) -> str:
    """A folder with the sheet in two drops of files."""
    path = scratch_path(t.spark, name)
    sheet.write.option("header", True).csv(path)
    return path


@query(
    "scan_chain_stock",
    """SELECT DISTINCT l.pos AS po, l.status, l.ref, l.contact AS supplier, l.bp_qty AS qty_ordered, c.n AS qty_counted,
  c.n - l.bp_qty AS qty_diff, c.product_id, l.name AS description, p.category, DATE '2024-01-31' AS date, 'A' AS team
FROM (SELECT upper(product_id) AS product_id, count(*) AS n FROM stock_scans GROUP BY 1) c
LEFT JOIN po_lines l ON l.sku = c.product_id
LEFT JOIN (SELECT DISTINCT simple_sku, category FROM plan_items) p ON p.simple_sku = c.product_id""",
)
def stock_chain(t: Tables) -> DataFrame:
    """The stock sheet drained into counts, history and report; a second run the day after finds nothing."""
    root = scratch_path(t.spark, "stock-chain")
    inbox = _inbox(t, "stock-inbox", t.stock_scans.select("product_id"))
    for day in (SHIFT, SHIFT + timedelta(days=1)):
        nightly.stock_inbox_job(root, inbox, t.po_lines, t.plan_items, day, "A")
    return nightly.known_state(t.spark, root, "rolling_stock", nightly.COUNTS)


def _damages_chain(t: Tables) -> str:
    root = scratch_path(t.spark, "damages-chain")
    damages = _inbox(t, "damage-inbox", t.damage_scans.select("product_id", "reason", "responsible"))
    surplus = _inbox(t, "oversupply-inbox", t.oversupply_scans.select("sku"))
    day = date(2024, 1, 20)
    for later in range(2):
        nightly.damages_inbox_job(root, damages, surplus, t.po_lines, day + timedelta(days=later))
    return root


@query(
    "scan_chain_damages",
    """SELECT DATE '2024-01-20' AS date, l.pos, upper(d.product_id) AS sku, d.reason, d.responsible, DATE '2024-01-20' AS as_of
FROM damage_scans d LEFT JOIN po_lines l ON l.sku = upper(d.product_id)""",
)
def damages_chain(t: Tables) -> DataFrame:
    return nightly.known_state(t.spark, _damages_chain(t), "damages", nightly.DAMAGES)


@query(
    "scan_chain_oversupply",
    f"SELECT date, supplier, po, sku, oversupply, date AS as_of FROM ({DAILY_SQL}) WHERE oversupply IS NOT NULL",
)
def oversupply_chain(t: Tables) -> DataFrame:
    return nightly.known_state(t.spark, _damages_chain(t), "oversupply", nightly.OVERSUPPLY)


SHIFT_COUNT = "product_id string, date date, qty_counted bigint"
COUNT_SQL = """SELECT upper(product_id) AS product_id, scan_date AS date, count(*) AS qty_counted
FROM stock_scans GROUP BY 1, 2"""


def _counts(t: Tables) -> DataFrame:
    found = scans.scan_counts(t.stock_scans.withColumnRenamed("scan_date", "date"), "product_id", "qty_counted", "date")
    return found.select("product_id", "date", "qty_counted")


@query("checked_history", f"{COUNT_SQL} UNION ALL SELECT * FROM ({COUNT_SQL}) WHERE date >= DATE '2024-01-15'")
def checked(t: Tables) -> DataFrame:
    """Two days of shift files and an unreadable one, each checked once."""
    path, manifest = (scratch_path(t.spark, name) for name in ("shift-files", "manifest"))
    counts = _counts(t)
    counts.write.parquet(path)
    read_checked_history(t.spark, path, manifest, SHIFT_COUNT, skip_unreadable=True)
    counts.filter(F.col("date") >= "2024-01-15").write.mode("append").parquet(path)
    counts.agg(F.concat(F.lit("rows: "), F.count(F.lit(1))).alias("value")).write.mode("append").text(path)
    return read_checked_history(t.spark, path, manifest, SHIFT_COUNT, skip_unreadable=True)


@query("incremental_history", COUNT_SQL)
def history_by_day(t: Tables) -> DataFrame:
    """Distinct history: what came before the middle of the month, then a handover that repeats a part of it."""
    counts = _counts(t)
    known = materialize(counts.filter(F.col("date") < "2024-01-20"), scratch_path(t.spark, "known"))
    return consolidated(known, counts.filter(F.col("date") >= "2024-01-10"), "product_id")


@query(
    "colocated_lines",
    """SELECT b.sku, b.pos, b.ref, b.status, b.bp_qty, q.qty_counted, q.last_qced, r.qty_received, r.last_received
FROM (SELECT sku, pos, ref, status, CAST(sum(bp_qty) AS BIGINT) AS bp_qty FROM po_lines
  WHERE sku IS NOT NULL AND pos IS NOT NULL AND ref IS NOT NULL AND status IS NOT NULL GROUP BY 1, 2, 3, 4) b
LEFT JOIN qced q ON q.sku = b.sku AND q.pos = b.pos LEFT JOIN taknin r ON r.sku = b.sku AND r.pos = b.pos""",
)
def colocated(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "nightly")
    receipts = t.received_msgs.filter(F.length("message_reference") < 7).select(
        F.col("item_code").alias("sku"), F.col("message_reference").alias("pos"), "quantity_received", "received_date"
    )
    layout = Layout(("sku", "pos"), 16)
    write_nightly(root, t.po_lines, t.qc_counts, receipts, layout)
    return nightly_line_facts(t.spark, root, layout)


@query("incremental_inbound", "SELECT * REPLACE (round(unit_cost, 4) AS unit_cost, round(total_cost, 4) AS total_cost) FROM inbound")
def refreshed(t: Tables) -> DataFrame:
    """The table of a month before, over the sources as they were without the last days, brought up to date."""
    new = inbound_sources(t)
    cut = F.lit(date(1997, 3, 1))
    old = new.__class__(
        plan=new.plan,
        po_lines=new.po_lines,
        po_header=new.po_header,
        dock_log=new.dock_log,
        qc=new.qc.filter(F.col("qc_date") < cut),
        damages=new.damages,
        received=new.received.filter(F.col("received_date") < cut),
        stock=new.stock,
    )
    month_before = AS_OF - timedelta(days=31)
    first = materialize(inbound_data(old, month_before), scratch_path(t.spark, "inbound"))  # read for its items and its rows
    state = incremental.inbound_state(t.spark, scratch_path(t.spark, "inbound-state"), first, 32)
    state.replace(first.select("sku").distinct(), first)
    changes = incremental.InboundChanges(
        qc=new.qc.filter(F.col("qc_date") >= cut), received=new.received.filter(F.col("received_date") >= cut)
    )
    incremental.refresh_inbound(state, new, changes, AS_OF, month_before)
    return rounded(state.read(), 4)


def _tab_sql(tab: str, keys: str) -> str:
    missing = {"supplier": "CAST(NULL AS VARCHAR) AS buyer", "buyer": "CAST(NULL AS VARCHAR) AS supplier"}
    extra = missing.get(tab, "CAST(NULL AS VARCHAR) AS supplier, CAST(NULL AS INTEGER) AS gl_month")
    measures = "total_cost, pos, total_units, missed_booking_days, not_booked, missed_plan_days, not_delivered, in_full, qty_damaged"
    return f"SELECT '{tab}' AS tab, gl_month, supplier, buyer, {measures} FROM (SELECT *, {extra} FROM ({compliance_sql(keys)}))"


@query("compliance_one_pass", " UNION ALL ".join(_tab_sql(tab, ", ".join(keys)) for tab, keys in compliance.TABS.items()))
def compliance_tabs(t: Tables) -> DataFrame:
    return rounded(compliance.compliance_tabs(inbound(t)), total_cost=2)


@query("ordered_master", f"SELECT {MASTER_SQL} FROM vis")
def ordered_master(t: Tables) -> DataFrame:
    """The visibility master written in order and read back."""
    path = scratch_path(t.spark, "ordered-master")
    master = visibility.visibility_master(inbound(t), t.sample_track)
    write_ordered(master, path, visibility.master_order(), rows_per_file=5000)
    return rounded(t.spark.read.schema(master.schema).parquet(path), 4)

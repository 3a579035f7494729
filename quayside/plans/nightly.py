"""The daily jobs: each reads the state of earlier ones, writes its reports and its part of the state.

A rerun of a job for the same day replaces what that day wrote and changes nothing else, also where
it has nothing to write now. State lives in one folder per table under `root`, partitioned so that a day is
replaced or expired without reading others; the history of samples is kept by item.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.membership import new_rows
from quayside.operators.setops import consolidate, stack
from quayside.plans import compliance, forecast, returns, samples, visibility
from quayside.plans.bookings import CONTACT_DAYS, contact_rows, receiving_report
from quayside.plans.inbound import InboundSources, inbound_data
from quayside.plans.incremental import InboundChanges, inbound_state, refresh_inbound
from quayside.plans.scans import (
    count_history,
    daily_damages,
    daily_order,
    rolling_damages,
    rolling_oversupply,
    shift_count,
    shift_order,
)
from quayside.session import remove_path, scratch_path
from quayside.sources import files, schemas
from quayside.sources.history import MANIFEST, checked_files, read_files
from quayside.sources.keyed import KeyedState
from quayside.sources.sinks import (
    append_state,
    expire_state,
    materialize,
    read_state,
    replace_partition,
    write_report,
)
from quayside.streaming.scans import Inbox, drain_chain, of_inbox

CONTACTS = (
    "seq long, piece int, date date, event string, pos string, supplier string, brand string, "
    "client_name string, client_email string"
)
DAMAGES = "date date, pos string, sku string, reason string, responsible string, as_of date"
OVERSUPPLY = "date date, supplier string, po string, sku string, oversupply long, as_of date"
SAMPLE_STATE = "sku string, " + ", ".join(f"{stage} date" for stage in schemas.SAMPLE_STAGES)
MANIFEST_COLUMNS = tuple(c.split()[0] for c in MANIFEST.split(", "))
COUNTS = (
    "date date, po string, status string, ref string, supplier string, qty_ordered long, "
    "qty_counted long, qty_diff long, product_id string, description string, category string, "
    "team string"
)


def state_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/state={table}"


def known_state(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """The state so far; empty before the first run."""
    if not files.exists(spark, state_path(root, table)):
        return spark.createDataFrame([], schema)
    return read_state(spark, state_path(root, table), schema)


def bookings_job(root: str, export: DataFrame, as_of: date, days: int = CONTACT_DAYS) -> None:
    """Receiving report of the next business day; contacts of the last `days` days.

    Contacts are kept per booking date. Dates that the export holds are written anew as the
    distinct rows of both, so an export may repeat earlier bookings or leave them out.
    """
    spark, start = export.sparkSession, as_of - timedelta(days=days)
    write_report(root, "receiving", {"bookings": receiving_report(export, as_of)}, as_of)
    new = contact_rows(export).filter(F.col("date") >= F.lit(start))
    old = known_state(spark, root, "contacts", CONTACTS)
    touched = old.join(new.select("date").distinct(), "date", "left_semi")
    # The partitions are read and replaced, hence the copy in between.
    copy = scratch_path(spark, "contacts")
    append_state(materialize(consolidate([touched, new], "pos"), copy), state_path(root, "contacts"), "date")
    remove_path(spark, copy)
    if files.exists(spark, state_path(root, "contacts")):
        expire_state(spark, state_path(root, "contacts"), "date", start)


def stock_job(
    root: str, scans: DataFrame, po_lines: DataFrame, plan: DataFrame, shift: date, team: str
) -> None:
    """Counts of a team's day, as a report and in the history that the team counts for."""
    path = state_path(root, count_history(team))
    replace_partition(shift_count(scans, po_lines, plan, shift, team), path, date=shift, team=team)
    counts = known_state(scans.sparkSession, root, count_history(team), COUNTS)
    own = counts.filter((F.col("date") == F.lit(shift)) & (F.col("team") == team))
    write_report(root, f"stock-{team}", {"counts": own}, shift, {"counts": shift_order()})


def damages_job(
    root: str, damages: DataFrame, oversupply: DataFrame, po_lines: DataFrame, as_of: date
) -> None:
    """Report of the day's damages and oversupply with known contacts; damages and oversupply kept per run day."""
    contacts = known_state(damages.sparkSession, root, "contacts", CONTACTS)
    report = daily_damages(damages, oversupply, po_lines, contacts, as_of)
    write_report(root, "damages", {"daily": report}, as_of, {"daily": daily_order()})
    replace_partition(rolling_damages(damages, po_lines), state_path(root, "damages"), as_of=as_of)
    surplus = rolling_oversupply(damages, oversupply, po_lines, as_of)
    replace_partition(surplus, state_path(root, "oversupply"), as_of=as_of)


def consolidation_job(spark: SparkSession, root: str, history_dir: str, schema: str, required: str = "product_id") -> DataFrame:
    """Distinct rows of all handed-over history files, of which only new ones are checked and read.

    What new files add is one numbered part of the state; their names are noted under the same number after it. A crash in
    between repeats the part. Files that cannot be read whole stay out; the manifest tells them.
    """
    base = root.rstrip("/")
    path, noted, manifest = state_path(root, "consolidated"), f"{base}/files=consolidated", f"{base}/files=checked"
    keys = ["path", "length", "modified"]
    known = read_state(spark, noted, f"{MANIFEST}, part int") if files.exists(spark, noted) else spark.createDataFrame([], f"{MANIFEST}, part int")
    part = (known.agg(F.max("part")).first()[0] + 1) if not known.isEmpty() else 0
    verdicts = checked_files(spark, history_dir, manifest, schema).filter("reason IS NULL")
    pending = verdicts.join(known.select(*keys), keys, "left_anti").select(*MANIFEST_COLUMNS)
    names = [r.path for r in pending.filter("rows > 0").select("path").collect()]
    history = known_state(spark, root, "consolidated", f"{schema}, part int")
    if names:
        rows = read_files(spark, history_dir, names, schema).dropna(subset=[required])
        fresh = new_rows(history.filter(F.col("part") < part).drop("part"), rows)
        replace_partition(fresh, path, part=part)
        replace_partition(pending, noted, part=part)
        history = known_state(spark, root, "consolidated", f"{schema}, part int")
    return history.drop("part")


# --- jobs that drain their scans themselves


def stock_inbox_job(
    root: str, inbox: str, po_lines: DataFrame, plan: DataFrame, shift: date, team: str
) -> None:
    """Drain a team's stock sheet: kept scans, counts of the day, history and report of one chain."""

    def follow(spark: SparkSession, scans: DataFrame, day: date) -> None:
        stock_job(root, scans.select("product_id"), po_lines, plan, day, team)

    boxes = {"stock": Inbox(inbox, "product_id string", "product_id")}
    _drain(po_lines.sparkSession, root, f"stock-{team}", boxes, shift, follow)


def damages_inbox_job(
    root: str, damages: str, oversupply: str, po_lines: DataFrame, as_of: date
) -> None:
    """Drain the sheets of damages and oversupply: kept scans, report, rolling damages and oversupply of one chain."""

    def follow(spark: SparkSession, scans: DataFrame, day: date) -> None:
        damaged = of_inbox(scans, "damages").select("product_id", "reason", "responsible", F.col("as_of").alias("scan_date"))
        damages_job(root, damaged, of_inbox(scans, "oversupply").select("sku"), po_lines, day)

    boxes = {
        "damages": Inbox(damages, schemas.DAMAGE_SHEET, "product_id"),
        "oversupply": Inbox(oversupply, schemas.OVERSUPPLY_SHEET, "sku"),
    }
    _drain(po_lines.sparkSession, root, "damages", boxes, as_of, follow)


def samples_inbox_job(
    root: str, inboxes: Sequence[str], plan: DataFrame, checks: DataFrame, shift: date
) -> None:
    """Drain the sheets of the six sample stages, in order, into the trail and its history."""

    def follow(spark: SparkSession, scans: DataFrame, day: date) -> None:
        samples_job(root, scans.select("sku", F.col("inbox").cast("int").alias("stage")), plan, checks, day)

    boxes = {str(i): Inbox(path, "sku string", "sku") for i, path in enumerate(inboxes, 1)}
    _drain(plan.sparkSession, root, "samples", boxes, shift, follow)


def _drain(spark: SparkSession, root: str, name: str, boxes: dict[str, Inbox], day: date, follow) -> None:
    base = root.rstrip("/")
    drain_chain(spark, boxes, f"{base}/scans={name}", f"{base}/checkpoint={name}", day, follow)


# --- samples


def sample_state(spark: SparkSession, root: str, buckets: int = 64) -> KeyedState:
    """The sample history by item: the last times per (item, first-stage time)."""
    return KeyedState(spark, state_path(root, "samples"), SAMPLE_STATE, "sku", buckets)


def samples_job(
    root: str, scans: DataFrame, plan: DataFrame, checks: DataFrame, shift: date, buckets: int = 64
) -> None:
    """Audit trail and summary from the history and new scans (sku, number of the stage), which the history then holds.

    Only the buckets of scanned items are rewritten. A rerun with the same scans changes nothing.
    """
    state = sample_state(plan.sparkSession, root, buckets)
    new = samples.stamped_stages(scans, shift)
    stages = samples.last_stages(stack([state.read(), new]))
    with_count = "qc_count" in checks.columns
    counted = checks if with_count else checks.withColumn("qc_count", F.lit(None).cast("long"))
    trail = samples.sample_trail(samples.sample_plan(plan, counted, shift), stages, with_count)
    copy = scratch_path(plan.sparkSession, "trail")
    trail = materialize(trail, copy)
    tabs = {"master": trail, "summary": samples.sample_summary(trail)}
    write_report(root, "samples", tabs, shift, {"master": samples.trail_order()})
    remove_path(plan.sparkSession, copy)
    state.upsert(new, samples.item_stages)


# --- the inbound table and what is cut from it


def visibility_job(
    root: str, sources: InboundSources, sample_track: DataFrame, as_of: date, **window: int
) -> DataFrame:
    """The inbound table from the counts and damages kept so far, written once, and its report.

    `qc` and `damages` of `sources` are replaced by the state. Only days up to `as_of` count,
    so an earlier day can be run again.
    """
    path = f"{root.rstrip('/')}/table=inbound/as_of={as_of.isoformat()}"
    table = materialize(inbound_data(fed_sources(root, sources, as_of), as_of, **window), path)
    copy = scratch_path(table.sparkSession, "master")
    wide = materialize(visibility.with_samples(table, sample_track), copy)
    master = wide.select(*visibility.MASTER_COLUMNS)
    tabs = {
        "master": master,
        "track": visibility.warehouse_track(master),
        "backlog": visibility.backlog(master),
        "units": visibility.units_by_month(wide),
        "capital": visibility.working_capital(wide),
        "progress": visibility.po_progress(wide),
        "funnel": visibility.config_funnel(table),
        "weeks": visibility.config_weeks(table),
        "po_days": visibility.po_summary(wide),
        "po_days_buyer": visibility.po_summary_per_buyer(wide),
    }
    orders = {
        "master": visibility.master_order(),
        "track": visibility.track_order(),
        "backlog": visibility.track_order(),
    }
    write_report(root, "visibility", tabs, as_of, orders)
    remove_path(table.sparkSession, copy)
    return table


INBOUND_BUCKETS = 256


def inbound_refresh_job(
    root: str,
    sources: InboundSources,
    changes: InboundChanges | None,
    as_of: date,
    previous: date | None,
    buckets: int = INBOUND_BUCKETS,
    **window: int,
) -> DataFrame:
    """The inbound table kept by item: only items that `changes` or the move of the month window touch are computed.

    Counts and damages come from the state, and so do their changes: what was kept since `previous`. Without `previous` the
    whole table is built. A rerun for the same day, or one after a crash, gives the same table.
    """
    spark = sources.plan.sparkSession
    fed = fed_sources(root, sources, as_of)
    path = state_path(root, "inbound")
    if previous is None:
        first = inbound_data(fed, as_of, **window)
        copy = scratch_path(spark, "inbound")
        whole = materialize(first, copy)
        state = inbound_state(spark, path, whole, buckets)
        state.replace(stack([whole.select("sku"), state.read().select("sku")]).distinct(), whole)
        remove_path(spark, copy)
        return state.read()
    # The schema of the table is that of its plan, which is not run.
    state = inbound_state(spark, path, inbound_data(fed, as_of, **window), buckets)
    since = F.lit(previous)
    counts = known_state(spark, root, "rolling_stock", COUNTS).filter((F.col("date") > since) & (F.col("date") <= F.lit(as_of)))
    damaged = known_state(spark, root, "damages", DAMAGES).filter((F.col("as_of") > since) & (F.col("as_of") <= F.lit(as_of)))
    own = InboundChanges(qc=counts.select(F.col("product_id").alias("sku")), damages=damaged.select("sku"))
    given = changes or InboundChanges()
    refresh_inbound(state, fed, replace(given, qc=own.qc, damages=own.damages), as_of, previous, **window)
    return state.read()


def fed_sources(root: str, sources: InboundSources, as_of: date) -> InboundSources:
    """`sources` with the counts and damages kept up to `as_of`."""
    spark, today = sources.plan.sparkSession, F.lit(as_of)
    counts = known_state(spark, root, "rolling_stock", COUNTS).filter(F.col("date") <= today)
    damaged = known_state(spark, root, "damages", DAMAGES).filter(F.col("as_of") <= today)
    qc = counts.select(
        F.col("product_id").alias("sku"),
        F.col("po").alias("pos"),
        "qty_counted",
        F.col("date").alias("qc_date"),
    )
    return replace(sources, qc=qc, damages=damaged.select("sku"))


def compliance_job(root: str, inbound: DataFrame, as_of: date) -> None:
    """Supplier and buyer compliance: by month, of the last month, and buyers over the whole period."""
    spark, copy = inbound.sparkSession, scratch_path(inbound.sparkSession, "compliance")
    every = materialize(compliance.compliance_tabs(inbound), copy)
    reports = {
        "supplier-compliance": {"all": "supplier", "last month": "supplier"},
        "buyer-compliance": {"all": "buyer", "last month": "buyer", "period": "buyer_period"},
    }
    for report, names in reports.items():
        tabs, orders = {}, {}
        for name, tab in names.items():
            keys = compliance.TABS[tab]
            rows = every.filter(F.col("tab") == tab).drop("tab", *({"gl_month", "supplier", "buyer"} - set(keys)))
            tabs[name] = compliance.last_month(rows, as_of) if name == "last month" else rows
            orders[name] = compliance.compliance_order(keys)
        write_report(root, report, tabs, as_of, orders)
    remove_path(spark, copy)


def forecast_job(root: str, inbound: DataFrame, as_of: date, back: int = 2, fwd: int = 2) -> None:
    """Planned against received units per delivery week, and the unit plan; `inbound` should cover the same months."""
    weeks = forecast.delivery_weeks(inbound, as_of, back, fwd)
    tabs = {"weeks": forecast.weekly_forecast(weeks), "plan": forecast.unit_plan(weeks, as_of, back, fwd)}
    write_report(root, "forecast", tabs, as_of)


def go_live_job(root: str, inbound: DataFrame, as_of: date) -> None:
    write_report(root, "go-live", {"track": visibility.go_live_track(inbound)}, as_of)


def returns_job(root: str, shipments: DataFrame, as_of: date) -> None:
    """The study of customer returns: costs by channel, collection times by zone and month."""
    sla = returns.sla_rows(shipments)
    tabs = {
        "collection": returns.collection_summary(shipments),
        "post office": returns.post_office_summary(shipments),
        "counter": returns.counter_summary(shipments),
        "collected": returns.collected_by_zone(sla),
        "not collected": returns.not_collected_by_zone(sla),
        "collected by month": returns.collected_by_month(sla),
        "not collected by month": returns.not_collected_by_month(sla),
    }
    write_report(root, "returns", tabs, as_of)

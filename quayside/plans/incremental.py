"""The inbound table brought up to date item by item."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import HEADER_PO_STRIP, as_key, blank_to_null, strip_chars
from quayside.operators.joins import skew_join
from quayside.operators.predicates import month_window
from quayside.operators.projections import item_key
from quayside.plans.inbound import InboundSources, inbound_data
from quayside.session import remove_path, scratch_path
from quayside.sources.keyed import KeyedState
from quayside.sources.sinks import materialize


@dataclass(frozen=True)
class InboundChanges:
    """Rows of each source that came, went or changed since the last run, the latter in both forms; None for no change."""

    plan: DataFrame | None = None
    po_lines: DataFrame | None = None
    po_header: DataFrame | None = None
    dock_log: DataFrame | None = None
    qc: DataFrame | None = None
    damages: DataFrame | None = None
    received: DataFrame | None = None
    stock: DataFrame | None = None


def _planned_key() -> F.Column:
    return item_key("barcode", "ean", "simple_sku").alias("sku")


def touched_items(
    sources: InboundSources, changes: InboundChanges, as_of: date, previous: date, back: int = 3, fwd: int = 1
) -> DataFrame:
    """Items (sku, perhaps a missing one) whose rows of the inbound table may differ between two runs.

    An item's rows depend on its planned rows, lines, counts, receipts, damages and stock, on the header and
    dock log of its lines' POs, and on the month window. So these are the items of changed rows, the items on changed
    POs, and those with a planned row that the window's move lets in or out.
    """
    found = []
    if changes.plan is not None:
        found.append(changes.plan.select(_planned_key()))
    if changes.po_lines is not None:
        found.append(changes.po_lines.select("sku"))
    if changes.qc is not None:
        found.append(changes.qc.select(as_key("sku").alias("sku")))
    if changes.damages is not None:
        found.append(changes.damages.select(as_key("sku").alias("sku")))
    for rows in (changes.received, changes.stock):
        if rows is not None:
            found.append(rows.select(F.col("item_code").alias("sku")))
    orders = []
    if changes.po_header is not None:
        orders.append(changes.po_header.select(strip_chars("order_id_raw", HEADER_PO_STRIP).alias("pos")))
    if changes.dock_log is not None:
        orders.append(changes.dock_log.select(blank_to_null("pos").alias("pos")))
    if orders:
        pos = reduce(DataFrame.union, orders).distinct()
        found.append(skew_join(sources.po_lines.select("sku", "pos"), pos, "pos", "left_semi").select("sku"))
    if previous != as_of:
        months = sources.plan.select(_planned_key(), "gl_year", "gl_month")
        now, before = (month_window(months, "gl_year", "gl_month", day, back, fwd) for day in (as_of, previous))
        keys = ["sku", "gl_year", "gl_month"]
        found += [now.select(keys).exceptAll(before.select(keys)).select("sku"), before.select(keys).exceptAll(now.select(keys)).select("sku")]
    if not found:
        return sources.plan.select(_planned_key()).filter("false")
    return reduce(DataFrame.union, found).distinct()


def refresh_inbound(
    state: KeyedState, sources: InboundSources, changes: InboundChanges, as_of: date, previous: date, back: int = 3, fwd: int = 1
) -> list[int]:
    """Recompute the touched items of the table that `state` keeps by item and put them in place of their old rows.

    `sources` are today's, whole; they are reduced to the touched items by semi joins before anything is
    aggregated. Returns the buckets that were rewritten.
    """
    spark, copy = state.spark, scratch_path(state.spark, "touched")
    items = materialize(touched_items(sources, changes, as_of, previous, back, fwd), copy)
    keyed = sources.plan.withColumn("_item", _planned_key())
    known = items.withColumnRenamed("sku", "_touched")
    plan = keyed.join(known, F.col("_item").eqNullSafe(F.col("_touched")), "left_semi").drop("_item")
    rows = inbound_data(replace(sources, plan=plan), as_of, back, fwd)
    touched = state.replace(items, rows)
    remove_path(spark, copy)
    return touched


def inbound_state(spark: SparkSession, path: str, table: DataFrame, buckets: int = 256) -> KeyedState:
    """A state for the inbound table, with the columns and types of `table`."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields)
    return KeyedState(spark, path, schema, "sku", buckets)


def changes_between(old: InboundSources, new: InboundSources) -> InboundChanges:
    """Rows that one version of the sources has and the other has not, each as often as it is there more."""
    parts = {}
    for f in fields(InboundChanges):
        a, b = getattr(old, f.name), getattr(new, f.name)
        parts[f.name] = a.exceptAll(b).union(b.exceptAll(a))
    return InboundChanges(**parts)

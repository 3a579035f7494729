"""Registration of queries and composition of their checking SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans import inbound as inbound_plan
from quayside.session import scratch_path
from quayside.sources.adapters import VIEWS, Tables
from quayside.sources.sinks import materialize

AS_OF = date(1997, 3, 15)
BOOKING_DAY = date(1996, 9, 27)
SCAN_DAY = date(2024, 1, 20)
SHIFT = date(2024, 1, 31)


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the domain tables under a query name."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Entry(build, sql)
        return build

    return register


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round computed doubles so that the order of summation does not show."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, special.get(c, digits)) for c in doubles})


def inbound_sources(t: Tables) -> inbound_plan.InboundSources:
    damages = t.damage_scans.select(F.upper("product_id").alias("sku"))
    return inbound_plan.InboundSources(
        plan=t.plan_items,
        po_lines=t.po_lines,
        po_header=t.po_header,
        dock_log=t.dock_log,
        qc=t.qc_counts,
        damages=damages,
        received=t.received_msgs,
        stock=t.stock_availability,
    )


# Set to a dict to write the inbound table once per input and window and let every report
# of the session read it, as a nightly run would. Unset, each query computes its own.
shared: dict[tuple[str, int, int], DataFrame] | None = None


def inbound(t: Tables, back: int = 3, fwd: int = 1) -> DataFrame:
    key = (t.sf_dir, back, fwd)
    if shared is not None and key in shared:
        return shared[key]
    table = inbound_plan.inbound_data(inbound_sources(t), AS_OF, back, fwd)
    if shared is not None:
        shared[key] = materialize(table, scratch_path(t.spark, "inbound"))
        return shared[key]
    return table


# Checking SQL for intermediate tables, by name. A name may use views and other names.
PARTS: dict[str, str] = {}

FRAME = (
    "row_class, seq, pos ASC NULLS LAST, ref ASC NULLS FIRST, status ASC NULLS FIRST, "
    "delivery_due ASC NULLS LAST"
)
BLANK = "sample|Sample|SAMPLE|samples|Samples|OS|Os|OVERSUPPLY|fraud"

PARTS["bp"] = """
SELECT sku, pos, ref, status, CAST(sum(bp_qty) AS BIGINT) AS bp_qty FROM po_lines
WHERE position('Cancel PO' IN status) = 0 AND sku IS NOT NULL AND pos IS NOT NULL AND ref IS NOT NULL
GROUP BY sku, pos, ref, status"""
PARTS["hdr"] = "SELECT DISTINCT trim(order_id_raw, 'PO#') AS pos, delivery_due FROM po_header"
PARTS["bookd"] = """
SELECT pos, CAST(date_booked AS DATE) AS date_booked FROM dock_log
WHERE date_booked <> '' AND pos <> ''
QUALIFY row_number() OVER (PARTITION BY pos ORDER BY seq) = 1"""
PARTS["receivd"] = """
SELECT pos, partial_delivery, CAST(date_received AS DATE) AS date_received FROM dock_log
WHERE date_received <> '' AND pos <> ''
QUALIFY row_number() OVER (PARTITION BY pos ORDER BY seq DESC) = 1"""
PARTS["qced"] = """
SELECT pos, sku, CAST(sum(qty_counted) AS BIGINT) AS qty_counted, max(qc_date) AS last_qced
FROM qc_counts GROUP BY pos, sku"""
PARTS["damagd"] = """
SELECT upper(product_id) AS sku, count(*) AS qty_damaged FROM damage_scans GROUP BY 1"""
PARTS["taknin"] = """
SELECT message_reference AS pos, item_code AS sku,
  CAST(sum(quantity_received) AS BIGINT) AS qty_received, max(received_date) AS last_received
FROM received_msgs WHERE length(message_reference) < 7 GROUP BY 1, 2"""
PARTS["putaway"] = """
SELECT item_code AS sku, CAST(sum(qty) AS BIGINT) AS qty_putaway FROM stock_availability GROUP BY 1"""
PARTS["planned"] = """
SELECT * FROM (
  SELECT *, coalesce(nullif(barcode, ''), nullif(ean, ''), simple_sku) AS sku FROM plan_items
) QUALIFY row_number() OVER (PARTITION BY sku, gl_month ORDER BY seq DESC) = 1"""


def _inbound_part(back: int, fwd: int) -> str:
    centre = AS_OF.year * 12 + AS_OF.month
    return f"""
SELECT seq, row_class, sku, simple_sku, simple_name, config_sku, config_name, category, nullif(buyer, '') AS buyer,
  nullif(supplier, '') AS supplier, designer, procurement_status, gl_day, gl_date, gl_month, gl_year, live_date, unit_cost,
  CASE WHEN row_class = 0 THEN total_units END AS total_units,
  CASE WHEN row_class = 0 THEN total_cost END AS total_cost,
  pos, nullif(ref, '') AS ref, status, bp_qty, delivery_due, date_booked,
  nullif(partial_delivery, '') AS partial_delivery, date_received, qty_counted, last_qced, qty_damaged, qty_received, last_received,
  CASE WHEN row_class = 0 OR (row_class = 2 AND NOT is_sample) THEN qty_putaway END AS qty_putaway,
  CASE WHEN regexp_matches(ref, 'OS|Os|OVERSUPPLY') THEN bp_qty END AS oversupply
FROM (
  SELECT *, CASE WHEN is_blanked THEN 2
    WHEN row_number() OVER (PARTITION BY sku, is_blanked ORDER BY seq, pos ASC NULLS LAST,
      ref ASC NULLS FIRST, status ASC NULLS FIRST, delivery_due ASC NULLS LAST) = 1 THEN 0
    ELSE 1 END AS row_class
  FROM (
    SELECT *, coalesce(regexp_matches(ref, '{BLANK}'), false) AS is_sample,
      coalesce(regexp_matches(ref, '{BLANK}'), false) OR procurement_status IS NOT DISTINCT FROM 'Deleted' AS is_blanked
    FROM (
      SELECT * FROM planned
      WHERE gl_year * 12 + gl_month BETWEEN {centre - back} AND {centre + fwd} AND total_cost > 0
    ) p
    LEFT JOIN bp USING (sku) LEFT JOIN hdr USING (pos) LEFT JOIN bookd USING (pos)
    LEFT JOIN receivd USING (pos) LEFT JOIN qced USING (sku, pos) LEFT JOIN damagd USING (sku)
    LEFT JOIN taknin USING (sku, pos) LEFT JOIN putaway USING (sku)
  )
)
WHERE NOT (row_class = 1 AND status IS NOT DISTINCT FROM 'Draft PO')"""


PARTS["inbound"] = _inbound_part(3, 1)
PARTS["inbound_wide"] = _inbound_part(2, 2)
PARTS["inbound_gl"] = _inbound_part(1, 3)
PARTS["vis"] = """
SELECT i.*, CASE WHEN s.s3_to_studio IS NOT NULL THEN 1 END AS sample_count
FROM inbound i LEFT JOIN sample_track s ON i.sku = s.sku"""
PARTS["vis_sale"] = f"""
SELECT * FROM vis WHERE ref IS NULL OR NOT regexp_matches(ref, '{BLANK}|not OK')"""


def reduced_part(source: str, id_col: str) -> str:
    """Three literal steps: unique (id, count date), flag repeats per PO, unique (PO, counted)."""
    order = f"last_qced ASC NULLS LAST, {FRAME}"
    return f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY pos ORDER BY {order}) > 1 AS dup FROM (
    SELECT * FROM {source}
    QUALIFY row_number() OVER (PARTITION BY {id_col}, last_qced ORDER BY {FRAME}) = 1
  )
) QUALIFY row_number() OVER (PARTITION BY pos, last_qced IS NOT NULL ORDER BY {order}) = 1"""


PARTS["vconf"] = reduced_part("inbound", "config_sku")
PARTS["vis_po"] = "SELECT * FROM vis_sale WHERE pos IS NOT NULL"
PARTS["pocount"] = reduced_part("vis_po", "pos")
PARTS["potrack"] = f"""
SELECT *, row_number() OVER (PARTITION BY pos ORDER BY last_qced ASC NULLS LAST, {FRAME}) > 1 AS dup
FROM (SELECT * FROM vis_po QUALIFY row_number() OVER (PARTITION BY pos, last_qced ORDER BY {FRAME}) = 1)"""


def _texts() -> dict[str, str]:
    return {**{name: text for name, (_, text) in VIEWS.items()}, **PARTS}


def _needed(sql: str, found: list[str], given: frozenset[str]) -> None:
    for name, text in _texts().items():
        if name not in found and name not in given and re.search(rf"\b{name}\b", sql):
            _needed(text, found, given)
            found.append(name)


def check_sql(sql: str, given: frozenset[str] = frozenset()) -> str:
    """Prefix the views and parts that a checking query names, in dependency order.

    Names in `given` exist as tables already.
    """
    names: list[str] = []
    _needed(sql, names, given)
    if not names:
        return sql.strip()
    texts = _texts()
    blocks = ",\n".join(f"{n} AS ({texts[n].strip()})" for n in names)
    return f"WITH {blocks}\n{sql.strip()}"

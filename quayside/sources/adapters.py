"""Domain tables as views over the driver's tables.

The text of a view is plain SQL that Spark and the checking engine both run. `seq`
is the arrival order that order-dependent operators use; it is unique per view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_ITEM = (
    "CASE WHEN l_partkey % 10 = 0 THEN concat('B', CAST(l_partkey AS STRING)) "
    "WHEN l_partkey % 9 = 0 AND l_partkey % 4 <> 0 THEN concat('E', CAST(l_partkey AS STRING)) "
    "ELSE concat('P', CAST(l_partkey AS STRING)) END"
)


def _repeated(table: str, condition: str) -> str:
    """All rows as version 0, and those that fit the condition once more as version 1."""
    return (
        f"(SELECT *, 0 AS v FROM {table} UNION ALL "
        f"SELECT *, 1 AS v FROM {table} WHERE {condition}) versions"
    )


_SAMPLE = "lpad(CAST(CAST(floor(event_id / 6) AS BIGINT) * 4 AS STRING), 6, '0')"

# Nine delivery zones, the last one missing.
_ZONES = (
    "Local",
    "Local Township",
    "Main Centre",
    "Main Township",
    "Outlying",
    "Regional Outlying",
    "National",
    "International",
)
_ZONE = (
    "CASE l_suppkey % 9 "
    + " ".join(f"WHEN {i} THEN '{zone}'" for i, zone in enumerate(_ZONES))
    + " END"
)


def _coded(condition: str, code: str, otherwise: str, column: str) -> str:
    """An item code of its own where `condition` holds, so that such rows stay but match no plan."""
    return f"CASE WHEN {condition} THEN concat('{code}', CAST({column} AS STRING)) ELSE {otherwise} END"


# View name -> (driver table, SQL).
VIEWS: dict[str, tuple[str, str]] = {
    "plan_items": (
        "part",
        f"""
SELECT seq, simple_sku, simple_name, barcode, ean, config_sku, config_name, category, buyer,
  supplier, designer, unit_cost, total_units, total_cost, procurement_status, gl_day, gl_date,
  CAST(month(gl_date) AS INT) AS gl_month, CAST(year(gl_date) AS INT) AS gl_year, live_date
FROM (
  SELECT p_partkey * 2 + v AS seq,
    concat('P', CAST(p_partkey AS STRING)) AS simple_sku,
    p_name AS simple_name,
    CASE WHEN p_partkey % 10 = 0 THEN concat('B', CAST(p_partkey AS STRING)) END AS barcode,
    CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 9 = 0 THEN concat('E', CAST(p_partkey AS STRING)) END AS ean,
    concat('C', lpad(CAST(p_partkey - p_partkey % 4 AS STRING), 6, '0')) AS config_sku,
    concat('Config ', CAST(p_partkey - p_partkey % 4 AS STRING)) AS config_name,
    p_type AS category, CASE WHEN p_partkey % 41 = 0 THEN '' ELSE p_brand END AS buyer,
    CASE WHEN p_partkey % 43 = 0 THEN '' ELSE concat('Supplier', CAST(p_partkey % 40 AS STRING)) END AS supplier,
    concat('Designer', CAST(p_partkey % 15 AS STRING)) AS designer,
    p_retailprice AS unit_cost, CAST(p_size + v AS BIGINT) AS total_units,
    CASE WHEN p_partkey % 23 = 0 THEN 0.0 ELSE CAST(p_retailprice * p_size AS DOUBLE) END AS total_cost,
    CASE WHEN p_partkey % 17 = 0 THEN 'Deleted' ELSE 'Approved' END AS procurement_status,
    CAST((p_partkey % 240 + 4) % 7 + 1 AS INT) AS gl_day,
    DATE '1996-11-01' + CAST(p_partkey % 240 AS INT) AS gl_date,
    CASE WHEN p_partkey % 3 <> 0 THEN DATE '1996-11-03' + CAST(p_partkey % 240 AS INT) END AS live_date
  FROM {_repeated("part", "p_partkey % 8 = 0")}
) t""",
    ),
    "po_lines": (
        "lineitem",
        f"""
SELECT {_coded("l_partkey % 13 = 0", "N", _ITEM, "l_partkey")} AS sku,
  CAST(l_orderkey AS STRING) AS pos,
  CASE WHEN l_orderkey % 11 = 0 THEN 'Sample order' WHEN l_orderkey % 13 = 0 THEN 'OVERSUPPLY' WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN 'not OK' WHEN l_orderkey % 41 = 0 THEN '' ELSE concat('ref ', CAST(l_orderkey % 100 AS STRING)) END AS ref,
  CASE WHEN l_orderkey % 19 = 0 THEN 'Cancel PO' WHEN l_orderkey % 5 = 0 THEN 'Draft PO' WHEN l_orderkey % 29 = 0 THEN NULL ELSE 'Placed' END AS status,
  CAST(l_quantity AS BIGINT) AS bp_qty,
  concat('Supplier', CAST(l_suppkey % 40 AS STRING)) AS contact,
  concat('Item ', CAST(l_partkey AS STRING)) AS name
FROM lineitem""",
    ),
    "po_header": (
        "orders",
        """
SELECT concat('PO#', CAST(o_orderkey AS STRING)) AS order_id_raw,
  CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS delivery_due
FROM orders""",
    ),
    "dock_log": (
        "orders",
        f"""
SELECT o_orderkey * 2 + v AS seq,
  CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey AS STRING) END AS pos,
  CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) + CAST(26 + o_orderkey % 7 + v AS INT) AS STRING) END AS date_booked,
  CASE WHEN v = 1 THEN 'Yes' WHEN o_orderkey % 8 = 1 THEN '' ELSE 'No' END AS partial_delivery,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) + CAST(24 + o_orderkey % 13 + 3 * v AS INT) AS STRING) END AS date_received
FROM {_repeated("orders", "o_orderkey % 9 = 0")}""",
    ),
    "qc_counts": (
        "lineitem",
        f"""
SELECT CAST(l_orderkey AS STRING) AS pos, {_coded("l_linenumber > 3", "Q", _ITEM, "l_partkey")} AS sku,
  CAST(l_quantity - l_linenumber % 3 AS BIGINT) AS qty_counted,
  CAST(l_shipdate AS DATE) AS qc_date
FROM lineitem""",
    ),
    "damage_scans": (
        "events",
        f"""
SELECT event_id AS seq, {_coded("event_type NOT IN ('error', 'view')", "D",
  "concat(CASE WHEN event_id % 2 = 0 THEN 'p' ELSE 'P' END, CAST(user_id AS STRING))", "user_id")} AS product_id,
  event_type AS reason, concat('qc', CAST(user_id % 7 AS STRING)) AS responsible, CAST(ts AS DATE) AS scan_date
FROM events""",
    ),
    "oversupply_scans": (
        "events",
        f"""
SELECT event_id AS seq, {_coded("event_type <> 'signup'", "O",
  "concat(CASE WHEN event_id % 2 = 0 THEN 'p' ELSE 'P' END, CAST(user_id * 2 AS STRING))", "user_id")} AS sku, CAST(ts AS DATE) AS scan_date
FROM events""",
    ),
    "stock_scans": (
        "events",
        f"""
SELECT event_id AS seq, {_coded("event_type NOT IN ('click', 'purchase')", "K",
  "concat(CASE WHEN event_id % 3 = 0 THEN 'p' ELSE 'P' END, CAST(user_id AS STRING))", "user_id")} AS product_id, CAST(ts AS DATE) AS scan_date
FROM events""",
    ),
    "received_msgs": (
        "lineitem",
        """
SELECT CASE WHEN l_orderkey % 17 = 0 OR l_linestatus <> 'F' THEN concat('MSG0000', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS message_reference,
  concat('P', CAST(l_partkey AS STRING)) AS item_code, CAST(l_quantity AS BIGINT) AS quantity_received, CAST(l_shipdate AS DATE) AS received_date
FROM lineitem""",
    ),
    "stock_availability": (
        "lineitem",
        f"""
SELECT {_coded("l_returnflag <> 'N'", "S", "concat('P', CAST(l_partkey AS STRING))", "l_partkey")} AS item_code, CAST(l_quantity AS BIGINT) AS qty FROM lineitem""",
    ),
    "booking_export": (
        "orders",
        """
SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS bdate, '08:00-09:30' AS btime,
  CASE WHEN o_orderkey % 12 = 0 THEN 'Merchant Delivery' ELSE 'Supplier Delivery' END AS event,
  concat('client', CAST(o_custkey AS STRING)) AS client_name,
  concat('contact of client', CAST(o_custkey AS STRING)) AS client_email,
  CASE WHEN o_orderkey % 50 = 0 THEN 'Yes' ELSE 'No' END AS is_cancelled,
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:00') AS record_date,
  concat('Brand: Brand', CAST(o_custkey % 25 AS STRING), ';POs: ',
    CASE WHEN o_orderkey % 5 = 0 THEN concat('PO ', CAST(o_orderkey AS STRING), ', ', CAST(o_orderkey + 1 AS STRING)) WHEN o_orderkey % 14 = 0 THEN 'none' ELSE concat('#', CAST(o_orderkey AS STRING)) END,
    ';Boxes: ', CAST(o_orderkey % 30 AS STRING), ';Partial: No;Supplier: Supplier', CAST(o_custkey % 40 AS STRING)) AS additional_fields
FROM orders""",
    ),
    "stage_scans": (
        "events",
        f"""
SELECT event_id * 2 + v AS seq, CAST(event_id % 6 AS INT) + 1 AS stage,
  CASE WHEN event_type = 'error' THEN concat('E', CAST(event_id % 500 AS STRING)) WHEN event_id % 12 < 6 THEN concat('C', {_SAMPLE}, 'xl00') ELSE concat('C', {_SAMPLE}) END AS sku,
  CAST(ts AS DATE) + CAST(v AS INT) AS scan_date
FROM {_repeated("events", "event_id % 60 = 0 OR event_id % 90 = 1")}""",
    ),
    "sample_track": (
        "events",
        """
SELECT concat('P', CAST(user_id AS STRING)) AS sku,
  max(CASE WHEN event_type = 'click' AND user_id % 3 <> 0 THEN CAST(ts AS DATE) END) AS s3_to_studio
FROM events GROUP BY user_id""",
    ),
    "inventory": (
        "lineitem",
        f"""
SELECT CAST(l_shipdate AS DATE) AS inv_date, concat('Brand', CAST(l_suppkey % 25 AS STRING)) AS brand_name, {_coded("l_returnflag <> 'A'", "I", "concat('P', CAST(l_partkey AS STRING))", "l_partkey")} AS simple_sku, CAST(l_linenumber % 3 AS BIGINT) AS qc_bad_qty, CAST(l_quantity AS BIGINT) AS qc_good_qty FROM lineitem""",
    ),
    "po_items": (
        "lineitem",
        f"""
SELECT CAST(l_orderkey AS STRING) AS purchase_order_number, {_coded("l_returnflag <> 'R'", "U", "concat('P', CAST(l_partkey AS STRING))", "l_partkey")} AS simple_sku, concat('Item ', CAST(l_partkey AS STRING)) AS simple_name, concat('Supplier', CAST(l_suppkey % 40 AS STRING)) AS supplier_name FROM lineitem""",
    ),
    "shipments": (
        "lineitem",
        f"""
SELECT concat(CASE l_returnflag WHEN 'R' THEN 'SPR' WHEN 'A' THEN 'COL' ELSE 'DEL' END, CAST(l_orderkey AS STRING)) AS shipment_id,
  CAST(l_shipdate AS DATE) AS poh_date,
  CASE WHEN l_linestatus = 'F' OR l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) + CAST(l_partkey % 16 - 2 AS INT) END AS pod_date,
  CASE WHEN l_linenumber = 1 THEN 0.0 ELSE CAST(l_tax * 1000 AS DOUBLE) END AS charge_out,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_quantity * 75 AS DOUBLE) END AS chargeable_mass,
  {_ZONE} AS zone
FROM lineitem""",
    ),
}


class Tables:
    """Lazy access to driver tables and domain views by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._driver: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        if name not in self._driver:
            self._driver[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._driver[name]

    def view(self, name: str) -> DataFrame:
        base, text = VIEWS[name]
        text = text.replace(f"FROM {base}", "FROM {" + base + "}")
        return self.spark.sql(text, **{base: self.driver(base)})

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

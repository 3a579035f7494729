"""The inbound table and its reports on small random inputs with every kind of gap and tie.

Inputs go to both Spark and DuckDB; the latter follows the literal steps.
"""

import datetime as dt
import random
from dataclasses import replace

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.operators.setops import stack
from quayside.plans import samples, visibility
from quayside.plans.inbound import (
    InboundSources,
    cancelled_orders,
    dock_events,
    inbound_data,
    planned_items,
    po_line_groups,
)
from quayside.registry.core import AS_OF, check_sql, inbound_sources
from quayside.sources.adapters import VIEWS, Tables
from quayside.sources.schemas import SAMPLE_STAGES
from tests.compare import rows_of
from tests.helpers import plan_text, rows

SKUS = ["P1", "P2", "P3", "E2", "B1", "P9", None]
POS = ["1", "2", "3", "44", "", None]
DAYS = [dt.date(1996, 12, 1) + dt.timedelta(20 * i) for i in range(9)]


class Views:
    """Random tables under the names of the domain views."""

    def __init__(self, spark, seed):
        rng = random.Random(seed)
        pick, day = rng.choice, lambda: rng.choice(DAYS)
        maybe = lambda v, p=0.25: None if rng.random() < p else v
        text = lambda d: pick(["", d.isoformat()])
        tables = {}
        plan = []
        for i in range(40):
            when = pick([dt.date(1996, 5, 1), *DAYS])
            plan.append(
                (
                    i, maybe(pick(["P1", "P2", "P3", "P9"]), 0.1), f"name {i % 3}",
                    maybe(pick(["B1", ""])), maybe(pick(["E2", ""])), f"C{i % 4}", f"config {i % 4}",
                    pick("xy"), maybe(pick("uv")), pick("st"), "d", float(rng.randint(1, 9)),
                    rng.randint(0, 5), float(rng.randint(0, 3)), pick(["Deleted", "Approved", None]),
                    when.isoweekday(), when, when.month, when.year, maybe(day()),
                )
            )
        tables["plan_items"] = (
            "seq long, simple_sku string, simple_name string, barcode string, ean string, "
            "config_sku string, config_name string, category string, buyer string, supplier string, "
            "designer string, unit_cost double, total_units long, total_cost double, "
            "procurement_status string, gl_day int, gl_date date, gl_month int, gl_year int, live_date date",
            plan,
        )
        tables["po_lines"] = (
            "sku string, pos string, ref string, status string, bp_qty long, contact string, name string",
            [
                (
                    pick(SKUS), pick(["1", "2", "3", "44", None]),
                    maybe(pick(["r1", "r2", "Sample", "OVERSUPPLY", "not OK", "fraud"]), 0.15),
                    maybe(pick(["Placed", "Draft PO", "Cancel PO"]), 0.1), rng.randint(1, 9), "s", "n",
                )
                for _ in range(60)
            ],
        )
        tables["po_header"] = (
            "order_id_raw string, delivery_due date",
            [(maybe("PO#" + pick(["1", "2", "3"]), 0.1), maybe(day(), 0.3)) for _ in range(12)],
        )
        tables["dock_log"] = (
            "seq long, pos string, date_booked string, partial_delivery string, date_received string",
            [(i, pick(POS), text(day()), pick(["Yes", "No"]), text(day())) for i in range(20)],
        )
        tables["qc_counts"] = (
            "pos string, sku string, qty_counted long, qc_date date",
            [(pick(POS[:4]), pick(SKUS[:6]), rng.randint(1, 5), day()) for _ in range(15)],
        )
        tables["damage_scans"] = (
            "seq long, product_id string, reason string, responsible string, scan_date date",
            [(i, pick(["p1", "P1", "b1", "P3"]), "r", "q", day()) for i in range(9)],
        )
        tables["received_msgs"] = (
            "message_reference string, item_code string, quantity_received long, received_date date",
            [
                (pick(["1", "2", "1234567"]), pick(SKUS[:6]), rng.randint(1, 5), day())
                for _ in range(15)
            ],
        )
        tables["stock_availability"] = (
            "item_code string, qty long",
            [(pick(SKUS[:6]), rng.randint(1, 5)) for _ in range(12)],
        )
        tables["sample_track"] = (
            "sku string, s3_to_studio date",
            [("P1", DAYS[0]), ("P2", None), ("B1", DAYS[1]), ("B1", DAYS[2]), (None, DAYS[1])],
        )
        self.con = duckdb.connect()
        for name, (schema, data) in tables.items():
            setattr(self, name, spark.createDataFrame(data, schema).repartition(3))
            frame = pd.DataFrame(data, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)
            self.con.register("incoming", frame)
            kinds = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}
            casts = ", ".join(
                f"CAST({c.split()[0]} AS {kinds[c.split()[1]]}) AS {c.split()[0]}" for c in schema.split(", ")
            )
            self.con.execute(f"CREATE TABLE {name} AS SELECT {casts} FROM incoming")

    def check(self, sql):
        found = self.con.execute(check_sql(sql, frozenset(VIEWS)))
        return rows_of([d[0] for d in found.description], found.fetchall())


@pytest.fixture(scope="module", params=range(3))
def views(request, spark):
    return Views(spark, request.param)


def bag_of(df):
    return rows_of(df.columns, df.collect())


def test_inbound(views):
    out = inbound_data(inbound_sources(views), AS_OF)
    expected = views.check("SELECT * FROM inbound")
    assert expected and bag_of(out) == expected


def test_partial_delivery_reduction(views):
    table = inbound_data(inbound_sources(views), AS_OF)
    out = visibility.config_rows(table).select("seq", "pos", "ref", "last_qced", "gl_month", "is_repeat")
    assert bag_of(out) == views.check(
        "SELECT seq, pos, ref, last_qced, gl_month, dup AS is_repeat FROM vconf"
    )


def test_monthly_order_counts(views):
    table = visibility.with_samples(inbound_data(inbound_sources(views), AS_OF), views.sample_track)
    out = visibility.po_summary_per_buyer(table)
    assert bag_of(out) == views.check(
        """SELECT buyer, gl_month, gl_day, count(*) FILTER (NOT dup) AS po_total,
        count(*) FILTER (NOT dup AND status = 'Draft PO') AS po_draft,
        count(*) FILTER (NOT dup AND date_received IS NOT NULL) AS po_received,
        count(*) FILTER (NOT dup AND date_received IS NULL) AS not_received
        FROM potrack WHERE buyer IS NOT NULL GROUP BY ALL"""
    )


def test_one_measure_row_per_item(views):
    table = inbound_data(inbound_sources(views), AS_OF)
    first = table.filter("row_class = 0").groupBy("sku").count()
    assert first.filter("count > 1 and sku is not null").count() == 0
    assert table.filter("row_class > 0 and total_units is not null").count() == 0


# --- hand tables -----------------------------------------------------------------


def test_line_groups_lose_missing_keys_and_cancelled(spark):
    lines = spark.createDataFrame(
        [
            ("a", "1", "r", "Placed", 2), ("a", "1", "r", "Placed", 3), ("a", "1", None, "Placed", 5),
            ("a", "1", "r", None, 7), ("a", "2", "r", "Cancel PO", 9), (None, "1", "r", "Placed", 4),
        ],
        "sku string, pos string, ref string, status string, bp_qty long",
    )
    assert rows(po_line_groups(lines)) == [("a", "1", "r", "Placed", 5)]
    assert rows(cancelled_orders(lines)) == [("2", 1)]


def test_dock_takes_first_booking_and_last_receipt(spark):
    log = spark.createDataFrame(
        [
            (1, "1", "", "No", "2015-01-09"), (2, "1", "2015-01-02", "No", ""),
            (3, "1", "2015-01-01", "Yes", "2015-01-05"), (4, "1", "", "Late", ""),
            (5, "", "2015-01-01", "No", "2015-01-01"), (6, None, "2015-01-01", "No", ""),
            (7, "2", "soon", "No", "05/01/2015"),
        ],
        "seq long, pos string, date_booked string, partial_delivery string, date_received string",
    )
    assert rows(dock_events(log)) == [
        ("1", dt.date(2015, 1, 2), "Yes", dt.date(2015, 1, 5)),
        ("2", None, "No", dt.date(2015, 1, 5)),
    ]


def test_window_follows_the_choice_of_the_last_row(spark):
    plan = spark.createDataFrame(
        [
            (1, "P1", None, "", 1997, 3, 5.0),
            (2, "P1", None, "", 1996, 3, 5.0),  # another year, same month: displaces the first
            (3, "P2", "", "", 1997, 2, 0.0),
            (4, "P3", "", "", 1997, 2, 1.0),
            (5, "P4", "", "", 1996, 12, 1.0),  # three months back, previous year
        ],
        "seq long, simple_sku string, barcode string, ean string, gl_year int, gl_month int, total_cost double",
    )
    assert rows(planned_items(plan, AS_OF, 3, 1), "sku") == [("P3",), ("P4",)]


def test_two_due_dates_give_two_rows_but_one_measure(spark):
    def frame(schema, *data):
        return spark.createDataFrame(list(data), schema)

    day = dt.date(1997, 3, 1)
    plan = frame(
        PLAN,
        (1, "P1", "n", None, None, "C", "c", "k", "b", "s", "d", 1.0, 7, 7.0, "Approved", 6, day, 3, 1997, None),
    )
    sources = InboundSources(
        plan=plan,
        po_lines=frame("sku string, pos string, ref string, status string, bp_qty long", ("P1", "1", "r", "Placed", 3)),
        po_header=frame("order_id_raw string, delivery_due date", ("PO#1", day), ("PO#1", None), ("PO#1", day)),
        dock_log=frame(
            "seq long, pos string, date_booked string, partial_delivery string, date_received string",
            (1, "1", "", "", ""),
        ),
        qc=frame("pos string, sku string, qty_counted long, qc_date date", ("1", "P1", 2, day)),
        damages=frame("sku string", ("P1",), ("P1",)),
        received=frame(
            "message_reference string, item_code string, quantity_received long, received_date date",
            ("1234567", "P1", 9, day),
        ),
        stock=frame("item_code string, qty long", ("P1", 4), ("P1", 5)),
    )
    out = inbound_data(sources, AS_OF)
    got = rows(out, "delivery_due", "total_units", "qty_putaway", "qty_counted", "qty_damaged", "qty_received")
    assert got == [(None, None, None, 2, 2, None), (day, 7, 9, 2, 2, None)]


PLAN = (
    "seq long, simple_sku string, simple_name string, barcode string, ean string, config_sku string, "
    "config_name string, category string, buyer string, supplier string, designer string, unit_cost double, "
    "total_units long, total_cost double, procurement_status string, gl_day int, gl_date date, gl_month int, "
    "gl_year int, live_date date"
)
LINES = "sku string, pos string, ref string, status string, bp_qty long"


def test_blank_cells_become_missing_and_unplanned_rows_do_not_travel(spark):
    """Blank buyer, reference and partial delivery; an unplanned item and its order stay out."""
    day = dt.date(1997, 3, 1)
    frame = lambda schema, *data: spark.createDataFrame(list(data), schema)
    sources = InboundSources(
        plan=frame(PLAN, (0, "P1", "n", None, "", "C1", "cn", "cat", "", "s", "d", 1.0, 7, 7.0, "Approved", 6, day, 3, 1997, day)),
        po_lines=frame(LINES, ("P1", "1", "", "Placed", 3), ("P9", "2", "r", "Placed", 3)),
        po_header=frame("order_id_raw string, delivery_due date", ("PO#1", day), ("PO#2", day)),
        dock_log=frame(
            "seq long, pos string, date_booked string, partial_delivery string, date_received string",
            (1, "1", "", "", "1997-02-02"), (2, "2", "", "", "1997-02-02"),
        ),
        qc=frame("pos string, sku string, qty_counted long, qc_date date", ("1", "P1", 2, day), ("2", "P9", 2, day)),
        damages=frame("sku string", ("P1",), ("P9",)),
        received=frame(
            "message_reference string, item_code string, quantity_received long, received_date date", ("1", "P1", 9, day)
        ),
        stock=frame("item_code string, qty long", ("P1", 4), ("P9", 5)),
    )
    out = inbound_data(sources, AS_OF)
    got = rows(out, "buyer", "ref", "partial_delivery", "date_received", "total_units", "qty_counted", "qty_putaway")
    assert got == [(None, None, None, dt.date(1997, 2, 2), 7, 2, 4)]
    # Lines, (item, PO) facts, item facts, header and dock log: each is reduced before it is grouped.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") >= 5


def test_a_hot_item_and_a_hot_order_are_split(spark, skewed_conf):
    """A third of the lines on one item, a third on one PO: both joins get split."""
    ids = spark.range(0, 60_000, 1, 8)
    third = F.col("id") % 3
    lines = ids.select(
        F.when(third == 0, F.lit("P1")).otherwise(F.concat(F.lit("P"), F.col("id") % 500)).alias("sku"),
        F.when(third == 1, F.lit("7")).otherwise((F.col("id") % 9000).cast("string")).alias("pos"),
        F.concat(F.lit("r"), (F.col("id") / 60).cast("int")).alias("ref"),
        F.lit("Placed").alias("status"),
        F.lit(1).cast("long").alias("bp_qty"),
    )
    day = F.lit(dt.date(1997, 3, 1))
    text = lambda name: F.lit("x").alias(name)
    plan = spark.range(500).select(
        F.col("id").alias("seq"), F.concat(F.lit("P"), "id").alias("simple_sku"), text("simple_name"),
        F.lit(None).cast("string").alias("barcode"), F.lit("").alias("ean"), text("config_sku"),
        text("config_name"), text("category"), text("buyer"), text("supplier"), text("designer"),
        F.lit(1.0).alias("unit_cost"), F.lit(3).cast("long").alias("total_units"), F.lit(3.0).alias("total_cost"),
        F.lit("Approved").alias("procurement_status"), F.lit(6).alias("gl_day"), day.alias("gl_date"),
        F.lit(3).alias("gl_month"), F.lit(1997).alias("gl_year"), day.alias("live_date"),
    )
    orders = spark.range(9000).select(F.col("id"), F.col("id").cast("string").alias("pos"))
    sources = InboundSources(
        plan=plan,
        po_lines=lines,
        po_header=orders.select(F.concat(F.lit("PO#"), "pos").alias("order_id_raw"), day.alias("delivery_due")),
        dock_log=orders.select(
            F.col("id").alias("seq"), "pos", F.lit("1997-02-01").alias("date_booked"),
            F.lit("No").alias("partial_delivery"), F.lit("1997-02-02").alias("date_received"),
        ),
        qc=lines.limit(10).select("pos", "sku", F.lit(1).cast("long").alias("qty_counted"), day.alias("qc_date")),
        damages=plan.select(F.col("simple_sku").alias("sku")),
        received=orders.limit(10).select(
            F.col("pos").alias("message_reference"), F.lit("P1").alias("item_code"),
            F.lit(1).cast("long").alias("quantity_received"), day.alias("received_date"),
        ),
        stock=plan.select(F.col("simple_sku").alias("item_code"), F.lit(1).cast("long").alias("qty")),
    )
    out = inbound_data(sources, AS_OF)
    found = out.collect()
    groups = lines.select("sku", "pos", "ref").distinct().count()
    assert len(found) == groups + 500 - lines.select("sku").distinct().count()
    assert sum(r["total_units"] or 0 for r in found) == 500 * 3
    assert plan_text(out).count("skew=true") >= 2


def test_header_and_dock_log_meet_the_lines_once(spark, sf_dir):
    """Rows of no line's PO, or of none, change nothing, and no semi join shuffles these tables row by row."""
    sources = inbound_sources(Tables(spark, sf_dir))
    day = F.lit(dt.date(1997, 3, 1))
    header = spark.range(40).select(F.when(F.col("id") > 0, F.concat(F.lit("PO#none"), "id")).alias("order_id_raw"), day.alias("delivery_due"))
    text = lambda value: F.lit(value)
    dock = spark.range(40).select(
        F.col("id").alias("seq"), F.when(F.col("id") > 0, F.concat(F.lit("none"), "id")).alias("pos"), text("1997-02-01").alias("date_booked"),
        text("No").alias("partial_delivery"), text("1997-02-02").alias("date_received"),
    )
    more = replace(sources, po_header=stack([sources.po_header, header]), dock_log=stack([sources.dock_log, dock]))
    out = inbound_data(more, AS_OF)
    assert bag_of(out) == bag_of(inbound_data(sources, AS_OF))
    joins = [line for line in plan_text(out).splitlines() if "LeftSemi" in line]
    assert joins and not any("pos#" in line for line in joins)


# --- samples ---------------------------------------------------------------------


def test_history_keeps_the_last_row_per_item_and_first_stage(spark):
    first, second = SAMPLE_STAGES[:2]
    day = dt.date(2024, 1, 2)
    history = spark.createDataFrame(
        [(1, "A", day, day), (2, "A", day, None), (3, "A", None, day), (4, "A", None, None), (5, "B", None, day)],
        f"seq long, sku string, {first} date, {second} date",
    )
    kept = samples.reduced_history(history).select("seq").collect()
    assert sorted(r.seq for r in kept) == [2, 4, 5]


@pytest.mark.parametrize("seed", range(2))
def test_last_stages_equal_the_chain(spark, seed):
    rng = random.Random(seed)
    tables = []
    for s in SAMPLE_STAGES:
        data = [
            (rng.choice(["C000001xl00", "C000001", "C000002", "C000003xl00"]), rng.choice(DAYS))
            for _ in range(rng.randint(1, 5))
        ]
        tables.append(spark.createDataFrame(data, f"sku string, {s} date"))
    con = duckdb.connect()
    scans = pd.DataFrame(
        [(t["sku"], i, t[s]) for i, (s, f) in enumerate(zip(SAMPLE_STAGES, tables), 1) for t in f.collect()],
        columns=["sku", "stage", "s"],
    )
    con.register("scans", scans)
    parts = [f"(SELECT sku, CAST(s AS DATE) AS {s} FROM scans WHERE stage = {i})" for i, s in enumerate(SAMPLE_STAGES, 1)]
    chain = parts[0] + "".join(f" FULL JOIN {p} USING (sku)" for p in parts[1:])
    stages = ", ".join(SAMPLE_STAGES)
    found = con.execute(f"SELECT sku, {stages} FROM {chain}")
    assert bag_of(samples.stage_chain(tables)) == rows_of([d[0] for d in found.description], found.fetchall())
    falling = ", ".join(f"{s} DESC NULLS LAST" for s in SAMPLE_STAGES[1:])
    found = con.execute(
        f"""SELECT config_sku, sku, {stages} FROM (
        SELECT *, CASE WHEN length(sku) = 11 THEN left(sku, 7) ELSE sku END AS config_sku FROM {chain})
        QUALIFY row_number() OVER (PARTITION BY config_sku, {SAMPLE_STAGES[0]} ORDER BY sku DESC, {falling}) = 1"""
    )
    assert bag_of(samples.last_stages(stack(tables))) == rows_of([d[0] for d in found.description], found.fetchall())
    one = samples.stage_chain(tables, latest_per_stage=True)
    assert one.groupBy("sku").count().filter(F.col("count") > 1).count() == 0

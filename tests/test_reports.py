"""Report plans on hand-written tables."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.operators.aggregates import describe, margins_pivot
from quayside.operators.setops import roll_history, stack
from quayside.operators.sorting import sort_keys
from quayside.plans import bookings, compliance, forecast, returns, scans, visibility
from tests.helpers import rows

FRIDAY = dt.date(2015, 6, 5)
MONDAY = dt.date(2015, 6, 8)
BOOKING = (
    "seq long, bdate date, btime string, event string, client_name string, client_email string, "
    "is_cancelled string, record_date string, additional_fields string"
)


def booking(seq, day, event, fields, cancelled="No"):
    return (seq, day, "08:00-09:00", event, f"client {seq}", None, cancelled, "2015-06-01 10:00", fields)


def fields(brand, pos, supplier="Sup"):
    return f"Brand: {brand};POs: {pos};Boxes: 4;Partial: No;Supplier: {supplier}"


@pytest.fixture(scope="module")
def export(spark):
    data = [
        booking(1, MONDAY, "Supplier Delivery", fields("X", "PO 11, #12\n13/ 14 15")),
        booking(2, MONDAY, "Merchant Delivery", fields("Y", "21")),
        booking(3, MONDAY, "Supplier Delivery", fields("X", "none"), "Yes"),
        booking(4, MONDAY, "Supplier Delivery", "Brand: X"),
        booking(5, MONDAY, "Supplier Delivery", fields("X", "11", "Late")),
        booking(6, FRIDAY, "Supplier Delivery", fields("X", "99")),
        booking(7, FRIDAY + dt.timedelta(1), "Supplier Delivery", fields("X", "98")),
        booking(8, FRIDAY - dt.timedelta(80), "Supplier Delivery", fields("X", "97")),
    ]
    return spark.createDataFrame(data, BOOKING)


def test_receiving_report(export):
    got = rows(bookings.receiving_report(export, FRIDAY), "pos", "brand", "supplier", "bdate", "btime")
    shown = [(p, b, s) for p, b, s, *_ in got]
    assert shown == [
        ("-", "X", None),
        ("11", "X", "Sup"),
        ("12", "X", "Sup"),
        ("13", "X", "Sup"),
        ("14", "X", "Sup"),
        ("15", "X", "Sup"),
        ("21", "Y", "Y"),  # two kinds of event: the merchant row shows its brand
    ]
    assert {(d, t) for *_, d, t in got} == {("2015/06/08", "08:00")}


def test_one_kind_of_event_keeps_the_supplier(export):
    merchant = export.filter("seq = 2")
    assert rows(bookings.receiving_report(merchant, FRIDAY), "supplier") == [("Sup",)]
    assert rows(bookings.receiving_report(export, FRIDAY - dt.timedelta(1)), "pos") == [("99",)]


def test_cancelled_bookings_can_be_left_out(export):
    kept = bookings.booked_orders(export, exclude_cancelled=True)
    assert kept.filter("seq = 3").count() == 0
    assert bookings.booked_orders(export).filter("seq = 3").count() == 1


def test_contacts_keep_blank_and_drop_missing_orders(spark, export):
    empty = bookings.contact_rows(export.limit(0))
    got = rows(bookings.rolling_contacts(empty, export, FRIDAY), "seq", "pos", "age")
    assert (3, "", 73) in got
    assert not [r for r in got if r[0] in (4, 8)]


def test_roll_history_keeps_the_boundary_day(spark):
    hist = spark.createDataFrame([(dt.date(2015, 1, 1),), (dt.date(2015, 1, 2),)], "date date")
    new = spark.createDataFrame([(dt.date(2015, 1, 12), 5)], "date date, extra int")
    got = rows(roll_history(hist, new, dt.date(2015, 1, 12), 10), "date", "extra", "age")
    assert got == [(dt.date(2015, 1, 2), None, 0), (dt.date(2015, 1, 12), 5, 10)]


def test_scans_are_folded_before_counting(spark):
    df = spark.createDataFrame([("a1",), ("A1",), ("b",), (None,)], "code string")
    assert rows(scans.scan_counts(df, "code", "n")) == [("A1", 2), ("B", 1)]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [("A1", "1", "r", "Placed", 3, "Sup", "item"), ("A1", "2", "r", "Placed", 4, "Sup", "item")],
        "sku string, pos string, ref string, status string, bp_qty long, contact string, name string",
    )


def test_shift_count(spark, lines):
    scanned = spark.createDataFrame([("a1",), ("A1",), ("zz",)], "product_id string")
    plan = spark.createDataFrame([("A1", "cat"), ("A1", "cat")], "simple_sku string, category string")
    out = scans.shift_count(scanned, lines, plan, FRIDAY, "B")
    assert rows(out, "product_id", "po", "qty_ordered", "qty_diff", "category", "team") == [
        ("A1", "1", 3, -1, "cat", "B"),
        ("A1", "2", 4, -2, "cat", "B"),
        ("ZZ", None, None, None, None, "B"),
    ]
    assert scans.count_history("S") == "samples_returned"
    assert scans.count_history("B") == "rolling_stock"


def test_daily_damages_and_states(spark, lines):
    damaged = spark.createDataFrame(
        [("a1", "tear", "q", FRIDAY), ("A1", "tear", "q", FRIDAY), ("c", "dirt", "q", FRIDAY)],
        "product_id string, reason string, responsible string, scan_date date",
    )
    surplus = spark.createDataFrame([("a1",), ("d",)], "sku string")
    contacts = spark.createDataFrame(
        [
            (FRIDAY, 1, 0, "1", "old", None), (FRIDAY, 2, 0, "1", "new", None),
            (FRIDAY, 3, 0, "", "blank", None), (FRIDAY, 4, 0, None, "none", None),
        ],
        "date date, seq long, piece int, pos string, client_name string, client_email string",
    )
    daily = scans.daily_damages(damaged, surplus, lines, contacts, FRIDAY)
    assert rows(daily, "sku", "po", "reason", "damaged", "oversupply", "client_name") == [
        ("A1", "1", "tear", 2, 1, "new"),
        ("A1", "2", "tear", 2, 1, None),
        ("C", None, "dirt", 1, None, None),
        ("D", None, None, None, 1, None),
    ]
    assert rows(scans.rolling_oversupply(damaged, surplus, lines, FRIDAY), "sku", "po") == [
        ("A1", "1"), ("A1", "2"), ("D", None),
    ]
    rolling = rows(scans.rolling_damages(damaged, lines), "sku", "pos")
    assert rolling == [("A1", "1"), ("A1", "1"), ("A1", "2"), ("A1", "2"), ("C", None)]


def test_bad_stock(spark):
    inventory = spark.createDataFrame(
        [(FRIDAY, "Br", "P1", 2), (MONDAY, "Br", "P2", 3)],
        "inv_date date, brand_name string, simple_sku string, qc_bad_qty long",
    )
    items = spark.createDataFrame(
        [("1", "P1", "n", "S"), ("2", "P3", "n", "S")],
        "purchase_order_number string, simple_sku string, simple_name string, supplier_name string",
    )
    surplus = spark.createDataFrame([("p3",), ("p4",)], "sku string")
    contacts = spark.createDataFrame(
        [(FRIDAY, 1, 0, "2", "who", None)],
        "date date, seq long, piece int, pos string, client_name string, client_email string",
    )
    out = scans.bad_stock(inventory, surplus, items, contacts, FRIDAY)
    assert rows(out, "simple_sku", "po", "damaged", "oversupply", "client_name") == [
        ("P1", "1", 2, None, None), ("P3", "2", None, 1, "who"), ("P4", None, None, 1, None),
    ]


INBOUND = (
    "gl_month int, supplier string, buyer string, pos string, ref string, status string, total_units long, "
    "total_cost double, qty_counted long, qty_damaged long, date_booked date, date_received date, delivery_due date"
)


def test_compliance(spark):
    d = dt.date
    data = [
        (3, "S", "b", "1", "r", "Placed", 10, 5.0, 8, 1, d(2015, 3, 1), d(2015, 3, 3), d(2015, 3, 4)),
        (3, "S", "b", "1", None, "Placed", None, None, 1, 1, None, d(2015, 3, 3), None),
        (3, "S", "b", "2", "r", "Placed", 10, 5.0, None, None, None, None, None),
        (3, "S", "b", "3", "r", "Draft PO", 10, 5.0, 9, None, None, None, None),
        (3, "S", "b", "4", "r", None, 10, 5.0, 9, None, None, None, None),
        (3, "S", "b", "5", "r", "Placed", 0, 5.0, 9, None, None, None, None),
        (3, "S", "b", "6", "Sample", "Placed", 10, 5.0, 9, None, None, None, None),
        (3, "T", None, "7", "r", "Placed", None, None, 4, None, None, None, None),
        (3, None, "b", "8", "r", "Placed", 1, None, 4, None, None, None, None),
    ]
    out = {r["supplier"]: r for r in compliance.supplier_compliance(spark.createDataFrame(data, INBOUND)).collect()}
    assert set(out) == {"S", "T"}
    s = out["S"]
    assert (s["pos"], s["total_units"], s["qty_damaged"]) == (2, 20, 2)
    assert (s["missed_booking_days"], s["missed_plan_days"]) == (2.0, 1.0)
    assert (s["not_booked"], s["not_delivered"]) == (0.5, 0.5)
    assert s["in_full"] == pytest.approx(9 / 20)
    assert out["T"]["in_full"] is None
    buyers = compliance.buyer_compliance_period(spark.createDataFrame(data, INBOUND))
    assert rows(buyers, "buyer", "pos") == [("b", 3)]
    january = spark.createDataFrame([(12,), (1,)], "gl_month int")
    assert rows(compliance.last_month(january, d(2015, 1, 10))) == [(12,)]


def test_compliance_order(spark):
    out = compliance.compliance(
        spark.createDataFrame(
            [(m, s, "b", str(i), None, "Placed", u, 1.0, 1, None, None, None, None)
             for i, (m, s, u) in enumerate([(2, "x", 5), (1, "y", 2), (1, "z", 4), (1, "w", None)])],
            INBOUND,
        ).withColumns({"missed_booking_days": F.lit(None).cast("double"), "missed_plan_days": F.lit(None).cast("double")}),
        ["gl_month", "supplier"],
    )
    # Within a month: in-full rising, missing first.
    order = compliance.compliance_order(["gl_month", "supplier"])
    assert [r["supplier"] for r in out.orderBy(*order).collect()] == ["w", "z", "y", "x"]


def test_forecast_weeks(spark):
    d = dt.date
    data = [
        ("r", "Approved", d(2015, 3, 1), d(2015, 4, 1), "c", 5, 1),   # due Sunday -> Wednesday 25 February
        ("r", None, None, d(2015, 3, 18), "c", 7, None),              # 14 days before go-live: 4 March
        ("r", "Deleted", None, d(2015, 3, 18), "c", 9, None),
        ("Sample", "Approved", None, d(2015, 3, 18), "c", 9, None),
        (None, "Approved", d(2015, 6, 3), d(2015, 3, 18), "c", 9, None),  # outside the window
        ("not OK", "Approved", d(2015, 3, 4), d(2015, 3, 18), None, 2, 3),
    ]
    df = spark.createDataFrame(
        data,
        "ref string, procurement_status string, delivery_due date, gl_date date, category string, "
        "total_units long, qty_received long",
    )
    weeks = forecast.delivery_weeks(df, d(2015, 3, 15))
    assert rows(forecast.weekly_forecast(weeks)) == [(d(2015, 2, 25), 5, 1), (d(2015, 3, 4), 9, 3)]
    plan = {r["category"]: r.asDict() for r in forecast.unit_plan(weeks, d(2015, 3, 15)).collect()}
    assert (plan["c"]["2015-02-25"], plan["c"]["2015-03-04"], plan["c"]["All"]) == (5, 7, 12)
    assert (plan["All"]["2015-03-04"], plan["All"]["All"], plan["c"]["2015-01-07"]) == (7, 12, None)


def test_margins_equal_the_sum_of_cells(spark):
    data = [(a, b, i) for i, (a, b) in enumerate((x, y) for x in "pqr" for y in "uvw")] + [(None, "u", 99)]
    df = spark.createDataFrame(data, "a string, b string, v int")
    out = {r["a"]: r.asDict() for r in margins_pivot(df, "a", "b", ["u", "v", "w"], "v").collect()}
    for row in out.values():
        assert row["All"] == row["u"] + row["v"] + row["w"]
    for c in ("u", "v", "w", "All"):
        assert out["All"][c] == sum(out[k][c] for k in "pqr")


def test_master_order_puts_missing_first(spark):
    keys = sort_keys(["d", "b"], nulls="first")
    df = spark.createDataFrame([(1, None), (None, 2), (1, 1), (None, None)], "d int, b int")
    assert [tuple(r) for r in df.orderBy(*keys).collect()] == [(None, None), (None, 2), (1, None), (1, 1)]
    keys = sort_keys(["d", "b"], descending=["b"], nulls="last")
    assert [tuple(r) for r in df.orderBy(*keys).collect()] == [(1, 1), (1, None), (None, 2), (None, None)]


def test_samples_fan_out_and_count_only_studio(spark):
    inbound = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "sku string")
    known = spark.createDataFrame(
        [("a", FRIDAY), ("a", None), ("b", None), (None, FRIDAY)], "sku string, s3_to_studio date"
    )
    assert rows(visibility.with_samples(inbound, known), "sku", "sample_count") == [
        (None, None), ("a", None), ("a", 1), ("b", None), ("c", None),
    ]


SHIPMENT = (
    "shipment_id string, poh_date date, pod_date date, charge_out double, chargeable_mass double, zone string"
)


def test_returns_study(spark):
    d = dt.date
    data = [
        ("SPR1", d(2015, 6, 5), d(2015, 6, 9), 10.0, 1000.0, "Local"),      # Friday to Tuesday: 2
        ("COL2", d(2015, 6, 5), d(2015, 6, 4), 20.0, 1000.5, "Local"),      # negative: unknown
        ("COL3", d(2015, 6, 5), None, 30.0, None, None),
        ("SPR4", d(2015, 12, 4), d(2015, 12, 7), 40.0, 2500.0, "Regional Outlying"),
        ("SPR5", d(2015, 6, 5), d(2015, 6, 8), 0.0, 100.0, "Local"),        # no charge
        ("DEL6", d(2015, 6, 5), d(2015, 6, 8), 9.0, 100.0, "Local"),
    ]
    df = spark.createDataFrame(data, SHIPMENT)
    out = {r["measure"]: r for r in returns.collection_summary(df).collect()}
    assert (out["charge_out"]["n"], out["charge_out"]["total"]) == (4, 100.0)
    assert (out["delay"]["n"], out["delay"]["total"]) == (2, 3.0)
    post = returns.post_office_summary(df).first()
    assert post["n"] == 4
    assert post["total"] == pytest.approx(47.65 * 2 + (47.65 + 5.5 * 2) + (47.65 + 5.5 * 3))
    counter = returns.counter_summary(df).first()
    assert counter["total"] == pytest.approx(54.57 * 3 + 81.43 + 6.86 * 3)
    sla = returns.sla_rows(df)
    assert rows(returns.collected_by_zone(sla), "sla_zone", "n", "p50") == [("Local", 1, 2.0)]
    assert rows(returns.not_collected_by_zone(sla)) == [("Local", 1)]
    month = returns.collected_by_month(sla).filter("statistic = 'mean'").first()
    assert (month["sla_zone"], month["m6"], month["m5"]) == ("Local", 2.0, None)
    assert rows(returns.not_collected_by_month(sla), "sla_zone", "m6", "m7") == [("Local", 1, None)]


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2,)], "i int")
    assert rows(stack([a, b])) == [(1, "x"), (2, None)]


def test_a_row_named_like_the_total_stays(spark):
    df = spark.createDataFrame([("All", "u", 5), ("b", "u", 7)], "a string, b string, v int")
    out = margins_pivot(df, "a", "b", ["u"], "v")
    assert sorted(tuple(r) for r in out.collect()) == [("All", 5, 5), ("All", 12, 12), ("b", 7, 7)]
    with pytest.raises(ValueError):
        margins_pivot(df, "a", "b", ["u", "All"], "v")


def test_deviation_far_from_zero(spark):
    values = [1e9 + i / 100_000 for i in range(1000)]
    out = describe(spark.createDataFrame([(v,) for v in values], "v double").repartition(7), [], "v", {"p50": 0.5}).first()
    assert abs(out["std"] / pd.Series(values).std() - 1) < 1e-3 and out["n"] == 1000

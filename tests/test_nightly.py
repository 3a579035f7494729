"""Two days of the jobs on hand-written tables."""

import datetime as dt

import pytest

from quayside.plans import nightly
from quayside.plans.inbound import InboundSources
from quayside.plans.nightly import (
    CONTACTS,
    COUNTS,
    DAMAGES,
    bookings_job,
    damages_job,
    known_state,
    stock_job,
    compliance_job,
    consolidation_job,
    forecast_job,
    go_live_job,
    inbound_refresh_job,
    returns_job,
    visibility_job,
)
from tests.helpers import bag, rows
from tests.test_inbound import PLAN
from tests.test_reports import BOOKING, SHIPMENT, booking, fields

THURSDAY, FRIDAY = dt.date(2015, 6, 4), dt.date(2015, 6, 5)


def run_day(spark, root, day, scanned, table=visibility_job):
    frame = lambda schema, *data: spark.createDataFrame(list(data), schema)
    live = dt.date(2015, 6, 20)
    lines = frame(
        "sku string, pos string, ref string, status string, bp_qty long, contact string, name string",
        ("P1", "11", "r", "Placed", 9, "Sup", "item"),
    )
    plan = frame(
        PLAN,
        (0, "P1", "n", None, "", "C1", "cn", "cat", "b", "s", "d", 1.0, 7, 7.0, "Approved", 6, live, 6, 2015, None),
    )
    export = frame(
        BOOKING,
        booking(day.day, day, "Supplier Delivery", fields("X", "11")),
        booking(1, day - dt.timedelta(70), "Supplier Delivery", fields("X", "97")),
    )
    bookings_job(root, export, day)
    stock_job(root, frame("product_id string", *[("p1",)] * scanned), lines, plan, day, "B")
    damaged = frame("product_id string, reason string, responsible string, scan_date date", ("p1", "tear", "q", day))
    damages_job(root, damaged, frame("sku string", ("P1",)), lines, day)
    sources = InboundSources(
        plan=plan,
        po_lines=lines.drop("contact", "name"),
        po_header=frame("order_id_raw string, delivery_due date", ("PO#11", live)),
        dock_log=frame(
            "seq long, pos string, date_booked string, partial_delivery string, date_received string",
            (1, "11", "2015-06-01", "No", "2015-06-03"),
        ),
        qc=None,
        damages=None,
        received=frame("message_reference string, item_code string, quantity_received long, received_date date", ("11", "P1", 4, day)),
        stock=frame("item_code string, qty long", ("P1", 4)),
    )
    return table(root, sources, frame("sku string, s3_to_studio date", ("P1", None)), day)


def test_two_days_and_a_rerun(spark, tmp_path):
    root = str(tmp_path)
    shown = ("pos", "qty_counted", "last_qced", "qty_damaged", "total_units")
    assert rows(run_day(spark, root, THURSDAY, 2), *shown) == [("11", 2, THURSDAY, 1, 7)]
    assert rows(known_state(spark, root, "contacts", CONTACTS), "date", "pos") == [
        (THURSDAY - dt.timedelta(70), "97"), (THURSDAY, "11"),
    ]
    for _ in range(2):  # the second run of Friday changes nothing
        assert rows(run_day(spark, root, FRIDAY, 3), *shown) == [("11", 5, FRIDAY, 2, 7)]
        # Thursday's oldest contact has passed the limit of 70 days.
        assert rows(known_state(spark, root, "contacts", CONTACTS), "date", "pos") == [
            (FRIDAY - dt.timedelta(70), "97"), (THURSDAY, "11"), (FRIDAY, "11"),
        ]
        counted = known_state(spark, root, "rolling_stock", COUNTS)
        assert rows(counted, "date", "team", "po", "qty_counted") == [(THURSDAY, "B", "11", 2), (FRIDAY, "B", "11", 3)]
        damaged = known_state(spark, root, "damages", DAMAGES)
        assert rows(damaged, "as_of", "date", "sku", "pos") == [
            (THURSDAY, THURSDAY, "P1", "11"), (FRIDAY, FRIDAY, "P1", "11"),
        ]
        report = spark.read.parquet(f"{root}/report=damages/tab=daily/as_of={FRIDAY}")
        assert rows(report, "sku", "po", "damaged", "oversupply", "client_name") == [("P1", "11", 1, 1, "client 5")]
        assert spark.read.parquet(f"{root}/report=visibility/tab=master/as_of={FRIDAY}").count() == 1


def test_the_inbound_table_follows_day_by_day(spark, tmp_path):
    root, days = str(tmp_path), {}

    def refresh(root, sources, samples, day):
        days[day] = visibility_job(root, sources, samples, day)
        previous = THURSDAY if day == FRIDAY else None
        return inbound_refresh_job(root, sources, None, day, previous, buckets=4)

    for day, scanned in ((THURSDAY, 2), (FRIDAY, 3), (FRIDAY, 3)):
        assert bag(run_day(spark, root, day, scanned, refresh)) == bag(days[day])


def test_reports_cut_from_the_inbound_table(spark, tmp_path):
    root = str(tmp_path)
    table = run_day(spark, root, FRIDAY, 3)
    compliance_job(root, table, FRIDAY)
    forecast_job(root, table, FRIDAY)
    go_live_job(root, table, FRIDAY)
    read = lambda report, tab: spark.read.parquet(f"{root}/report={report}/tab={tab}/as_of={FRIDAY}")
    assert rows(read("supplier-compliance", "all"), "gl_month", "supplier", "pos") == [(6, "s", 1)]
    assert rows(read("supplier-compliance", "last month"), "supplier") == []
    assert rows(read("buyer-compliance", "period"), "buyer", "total_units") == [("b", 7)]
    assert "gl_month" not in read("buyer-compliance", "period").columns
    assert rows(read("forecast", "weeks"), "qty_planned", "qty_received") == [(7, 4)]
    assert rows(read("go-live", "track"), "tab", "planned") == [("month", 1), ("week", 1)]
    assert rows(read("visibility", "backlog"), "sku") == []
    assert rows(read("visibility", "units"), "gl_month", "units_planned") == [(6, 7)]
    shipments = spark.createDataFrame([("SPR1", THURSDAY, FRIDAY, 10.0, 500.0, "Local")], SHIPMENT)
    for _ in range(2):
        returns_job(root, shipments, FRIDAY)
    assert rows(read("returns", "collection"), "measure", "total") == [("charge_out", 10.0), ("delay", 1.0)]


def test_a_day_corrected_to_nothing(spark, tmp_path):
    root = str(tmp_path)
    run_day(spark, root, THURSDAY, 2)
    run_day(spark, root, FRIDAY, 3)
    run_day(spark, root, FRIDAY, 0)
    assert rows(known_state(spark, root, "rolling_stock", COUNTS), "date") == [(THURSDAY,)]


@pytest.mark.parametrize("crash", [False, True])
def test_handed_over_files_are_consolidated_once(spark, tmp_path, monkeypatch, crash):
    root, box, schema = str(tmp_path / "root"), str(tmp_path / "box"), "product_id string, date date, qty_counted bigint"
    hand = lambda *data: spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(box)
    hand(("a", THURSDAY, 1), ("a", THURSDAY, 1), (None, THURSDAY, 9), ("b", None, 2))
    shown = lambda: rows(consolidation_job(spark, root, box, schema))
    first = [("a", THURSDAY, 1), ("b", None, 2)]
    assert shown() == first
    hand(("a", THURSDAY, 1), ("c", FRIDAY, 3), ("b", None, 2))
    (tmp_path / "box" / "broken.parquet").write_text("no parquet")
    if crash:  # the new part is written, its files are not noted
        real, calls = nightly.replace_partition, []

        def fail(*args, **values):
            calls.append(1)
            if len(calls) == 2:
                raise RuntimeError("killed")
            real(*args, **values)

        with monkeypatch.context() as broken, pytest.raises(RuntimeError):
            broken.setattr(nightly, "replace_partition", fail)
            shown()
        hand(("d", FRIDAY, 4))
    expected = sorted([*first, ("c", FRIDAY, 3), *([("d", FRIDAY, 4)] if crash else [])], key=str)
    for _ in range(2):
        assert sorted(shown(), key=str) == expected
    reads = []
    monkeypatch.setattr(nightly, "read_files", lambda *a: reads.append(a))
    assert sorted(shown(), key=str) == expected and not reads  # nothing is read again

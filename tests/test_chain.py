"""Draining inboxes through a chain of writes: a crash at any write neither loses nor doubles a scan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.plans import nightly
from quayside.plans.nightly import (
    COUNTS,
    DAMAGES,
    OVERSUPPLY,
    damages_inbox_job,
    known_state,
    sample_state,
    samples_inbox_job,
    stock_inbox_job,
)
from tests.helpers import rows
from tests.test_inbound import PLAN

DAY, NEXT = dt.date(2015, 6, 4), dt.date(2015, 6, 5)


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [("P1", "11", "r", "Placed", 9, "Sup", "item"), ("P1", "12", "r", "Placed", 1, "Sup", "item")],
        "sku string, pos string, ref string, status string, bp_qty long, contact string, name string",
    )


@pytest.fixture
def plan(spark):
    live = dt.date(2015, 6, 20)
    return spark.createDataFrame(
        [(0, "P1", "n", None, "", "C1", "cn", "cat", "b", "s", "d", 1.0, 7, 7.0, "Approved", 6, live, 6, 2015, None)], PLAN
    )


def drop(tmp_path, box, name, header, *codes):
    folder = tmp_path / "in" / box
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(header + "\n" + "".join(f"{c}\n" for c in codes))
    return str(folder)


def stock(spark, root, inbox, lines, plan, day):
    stock_inbox_job(root, inbox, lines, plan, day, "B")
    return rows(known_state(spark, root, "rolling_stock", COUNTS), "date", "po", "product_id", "qty_counted")


def counted(day, **codes):
    return sorted(
        ((day, po, c, n) for c, n in codes.items() for po in (("11", "12") if c == "P1" else (None,))),
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_days_and_drops(spark, tmp_path, lines, plan):
    root = str(tmp_path / "root")
    inbox = drop(tmp_path, "stock", "a.csv", "product_id", "p1", "P1", "", "zz")
    assert stock(spark, root, inbox, lines, plan, DAY) == counted(DAY, P1=2, ZZ=1)
    assert stock(spark, root, inbox, lines, plan, DAY) == counted(DAY, P1=2, ZZ=1)
    drop(tmp_path, "stock", "b.csv", "product_id", "P1")  # a second sheet of the day adds to it
    assert stock(spark, root, inbox, lines, plan, DAY) == counted(DAY, P1=3, ZZ=1)
    drop(tmp_path, "stock", "c.csv", "product_id", "P1", "P1")
    both = sorted(counted(DAY, P1=3, ZZ=1) + counted(NEXT, P1=2), key=lambda r: [(v is not None, str(v)) for v in r])
    assert stock(spark, root, inbox, lines, plan, NEXT) == both
    report = spark.read.parquet(f"{root}/report=stock-B/tab=counts/as_of={NEXT}")
    assert rows(report, "po", "qty_counted") == [("11", 2), ("12", 2)]


@pytest.mark.parametrize("where", ["replace_partition", "write_report", "shift_count"])
@pytest.mark.parametrize("again", [DAY, NEXT])
def test_a_crash_in_the_chain(spark, tmp_path, monkeypatch, lines, plan, where, again):
    root = str(tmp_path / "root")
    inbox = drop(tmp_path, "stock", "a.csv", "product_id", "p1", "zz")
    real, calls = getattr(nightly, where), []

    def fail(*args, **options):
        if where != "shift_count":  # the write itself is done
            real(*args, **options)
        calls.append(where)
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(nightly, where, fail)
        with pytest.raises(Exception, match="killed"):
            stock(spark, root, inbox, lines, plan, DAY)
    assert calls
    drop(tmp_path, "stock", "b.csv", "product_id", "P1")
    # The repeated batch keeps the day that it was first kept on, also when it is repeated on the next.
    found = stock(spark, root, inbox, lines, plan, again)
    if again == DAY:
        assert found == counted(DAY, P1=2, ZZ=1)
    else:
        assert found == sorted(counted(DAY, P1=1, ZZ=1) + counted(NEXT, P1=1), key=lambda r: [(v is not None, str(v)) for v in r])


def test_damages_and_oversupply_come_from_one_batch(spark, tmp_path, monkeypatch, lines):
    root = str(tmp_path / "root")
    header = "product_id,reason,responsible"
    damages = drop(tmp_path, "damages", "a.csv", header, "p1,tear,q", "P1,tear,q", "c,dirt,q")
    surplus = drop(tmp_path, "oversupply", "a.csv", "sku", "p1", "d")
    calls, real = [], nightly.replace_partition

    def fail_once(*args, **options):
        real(*args, **options)
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(nightly, "replace_partition", fail_once)
        with pytest.raises(Exception, match="killed"):
            damages_inbox_job(root, damages, surplus, lines, DAY)
    for _ in range(2):
        damages_inbox_job(root, damages, surplus, lines, DAY)
        kept = known_state(spark, root, "damages", DAMAGES)
        assert rows(kept, "as_of", "sku", "pos") == [(DAY, "C", None), *[(DAY, "P1", p) for p in ("11", "11", "12", "12")]]
        over = known_state(spark, root, "oversupply", OVERSUPPLY)
        assert rows(over, "as_of", "sku", "po", "oversupply") == [(DAY, "D", None, 1), (DAY, "P1", "11", 1), (DAY, "P1", "12", 1)]
        report = spark.read.parquet(f"{root}/report=damages/tab=daily/as_of={DAY}")
        assert rows(report, "sku", "po", "damaged", "oversupply") == [("C", None, 1, None), ("D", None, None, 1), ("P1", "11", 2, 1), ("P1", "12", 2, 1)]


def test_samples_over_two_days_and_a_rerun(spark, tmp_path, plan):
    root = str(tmp_path / "root")
    checks = spark.createDataFrame([("P1", DAY)], "simple_sku string, qc_date date")
    boxes = [drop(tmp_path, f"s{i}", "a.csv", "sku", *(["c1", "x2"] if i == 1 else ["c1"] if i == 3 else [])) for i in range(1, 7)]
    samples_inbox_job(root, boxes, plan, checks, DAY)
    shown = ("config_sku", "sku", "qc_date", "s1_wh_out", "s3_to_studio", "s4_from_studio")
    master = lambda day: rows(spark.read.parquet(f"{root}/report=samples/tab=master/as_of={day}"), *shown)
    assert master(DAY) == [("C1", "C1", DAY, DAY, DAY, None), ("X2", "X2", None, DAY, None, None)]
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "root" / "state=samples").glob("bucket=*/*.parquet")}
    drop(tmp_path, "s4", "b.csv", "sku", "c1")
    for _ in range(2):
        samples_inbox_job(root, boxes, plan, checks, NEXT)
        assert master(NEXT) == [("C1", "C1", DAY, DAY, DAY, NEXT), ("X2", "X2", None, DAY, None, None)]
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "root" / "state=samples").glob("bucket=*/*.parquet")}
    assert {p: t for p, t in after.items() if p in before and before[p] == t}  # the other item's bucket is as it was
    state = sample_state(spark, root).read()
    assert rows(state.select("sku", "s1_wh_out", "s4_from_studio")) == [("C1", DAY, NEXT), ("X2", DAY, None)]
    summary = spark.read.parquet(f"{root}/report=samples/tab=summary/as_of={NEXT}")
    assert rows(summary, "gl_year", "gl_month", "s1_wh_out", "s4_from_studio") == [(2015, 6, 1, 1)]
    assert summary.filter(F.col("qc_date") == 1).count() == 1

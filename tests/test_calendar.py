import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions.calendar import (
    busdays,
    days_apart,
    iso_week_day,
    next_business_day,
    shift_month,
)
from quayside.operators.predicates import month_window
from quayside.plans.bookings import next_workday
from quayside.plans.forecast import weeks_in_window
from tests.helpers import rows


def test_busdays_equals_numpy(spark):
    rng = np.random.default_rng(7)
    base = np.datetime64("1968-01-01")
    starts = base + rng.integers(0, 25_000, 4000)
    ends = starts + rng.integers(-40, 40, 4000)
    pairs = [(a.item(), b.item()) for a, b in zip(starts, ends)]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", busdays("a", "b").alias("n")).collect()
    for r in got:
        assert r["n"] == np.busday_count(r["a"], r["b"]), r


def test_busdays_without_an_end(spark):
    df = spark.createDataFrame([(dt.date(2015, 1, 1), None)], "a date, b date")
    assert df.select(busdays("a", "b")).first()[0] is None


def test_iso_week_day(spark):
    days = [dt.date(2008, 12, 20) + dt.timedelta(i) for i in range(3000)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", iso_week_day("d").alias("w")).collect():
        year, week, _ = r["d"].isocalendar()
        assert r["w"] == dt.date.fromisocalendar(year, week, 3)


def test_next_business_day(spark):
    days = [dt.date(2015, 6, 1) + dt.timedelta(i) for i in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", next_business_day("d").alias("n")).collect():
        assert r["n"] == next_workday(r["d"])
    assert next_workday(dt.date(2015, 6, 5)) == dt.date(2015, 6, 8)
    assert next_workday(dt.date(2015, 6, 6)) == dt.date(2015, 6, 7)


def test_fractional_days(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2015, 1, 1, 12), dt.datetime(2015, 1, 3)), (None, dt.datetime(2015, 1, 3))],
        "a timestamp, b timestamp",
    )
    assert [r[0] for r in df.select(days_apart("a", "b")).collect()] == [1.5, None]


@settings(max_examples=50, deadline=None)
@given(st.integers(2000, 2030), st.integers(1, 12), st.integers(-30, 30))
def test_shift_month(year, month, k):
    y, m = shift_month(dt.date(year, month, 28), k)
    assert y * 12 + m == year * 12 + month + k and 1 <= m <= 12


def test_month_window_crosses_a_year_end(spark):
    df = spark.createDataFrame(
        [(2014, 9), (2014, 10), (2014, 12), (2015, 1), (2015, 2), (2015, 3), (2016, 1)],
        "y int, m int",
    )
    got = rows(month_window(df, "y", "m", dt.date(2015, 1, 31), 3, 1))
    assert got == [(2014, 10), (2014, 12), (2015, 1), (2015, 2)]


def test_weeks_in_window():
    weeks = weeks_in_window(dt.date(1997, 3, 15))
    assert weeks[0] == dt.date(1997, 1, 1) and weeks[-1] == dt.date(1997, 5, 28)
    assert all(w.weekday() == 2 for w in weeks) and len(weeks) == 22


def test_text_forms(spark):
    from quayside.functions.text import config_code, strip_chars, token_before

    df = spark.createDataFrame([("PO#12P3#", "C000004xl00", "08:00-09:30")], "p string, s string, t string")
    out = df.select(
        strip_chars("p", "PO#"), config_code("s"), config_code(F.lit("C12")), token_before("t", "-")
    ).first()
    assert tuple(out) == ("12P3", "C000004", "C12", "08:00")

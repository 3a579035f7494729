"""Rules for missing values, one small table each."""

import datetime as dt

from pyspark.sql import functions as F

from quayside.functions.calendar import parse_timestamp
from quayside.functions.numeric import classify_last_match, ratio, zoned_tariff
from quayside.functions.text import kv_fields
from quayside.operators.aggregates import (
    describe,
    group_agg,
    missing_share,
    scale_by_first,
    waterfall,
)
from quayside.operators.joins import left_join
from quayside.operators.predicates import (
    NOT_FOR_SALE,
    differs,
    drop_missing,
    exclude_matching,
    include_matching,
    not_cancelled,
    outside,
    placed,
)
from quayside.operators.projections import blanks_to_null, item_key, overwrite_where
from tests.helpers import rows


def test_grouping_drops_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(group_agg(df, ["k"], F.sum("v").alias("v"))) == [("a", 4)]
    kept = group_agg(df, ["k"], F.sum("v").alias("v"), drop_null_keys=False)
    assert rows(kept) == [(None, 2), ("a", 4)]


def test_missing_keys_do_not_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 9), ("a", 8)], "k string, w int")
    assert rows(left_join(left, right, "k")) == [(None, 1, None), ("a", 2, 8)]


def test_exclusion_keeps_missing_text(spark):
    df = spark.createDataFrame(
        [("Sample x",), (None,), ("ok",), ("BOSS",), ("Oslo",)], "ref string"
    )
    assert rows(exclude_matching(df, "ref", NOT_FOR_SALE)) == [(None,), ("ok",)]
    assert rows(include_matching(df, "ref", NOT_FOR_SALE)) == [("BOSS",), ("Oslo",), ("Sample x",)]


def test_missing_differs_from_any_value(spark):
    df = spark.createDataFrame([("Draft PO",), (None,), ("Placed",)], "s string")
    assert rows(df.filter(differs("s", "Draft PO"))) == [(None,), ("Placed",)]
    assert rows(df.filter(placed("s"))) == [("Placed",)]
    df = spark.createDataFrame([("Cancel PO",), (None,), ("x Cancel PO y",), ("Placed",)], "s string")
    assert rows(df.filter(not_cancelled("s"))) == [("Placed",)]


def test_missing_zone_is_outside_and_dear(spark):
    df = spark.createDataFrame(
        [("Local", 2000.0), (None, 2000.0), ("Local", 2000.5), (None, 2000.5), ("Local", None)],
        "zone string, mass double",
    )
    out = df.select(outside("zone", ["Local"]), F.round(zoned_tariff("mass", "zone"), 2))
    assert [tuple(r) for r in out.collect()] == [
        (False, 54.57),
        (True, 81.43),
        (False, round(54.57 + 4.95 * 3, 2)),
        (True, round(81.43 + 6.86 * 3, 2)),
        (False, None),
    ]


def test_division_by_zero_is_missing(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, 0.5]
    counts = spark.createDataFrame([(4, 2), (0, 0)], "n int, m int")
    assert rows(scale_by_first(counts, ["n", "m"])) == [(None, None), (1.0, 0.5)]


def test_short_field_lists_and_second_separator(spark):
    df = spark.createDataFrame([("A: x: y;B: z",), (None,), ("A",)], "f string")
    out = df.select(*kv_fields("f", ["a", "b", "c"]))
    assert [tuple(r) for r in out.collect()] == [("x", "z", None), (None,) * 3, (None,) * 3]


def test_bad_dates_become_missing(spark):
    df = spark.createDataFrame([("2015-02-30",), ("28/02/2015",), ("x",), (None,)], "d string")
    out = df.select(parse_timestamp("d", ["yyyy-MM-dd", "dd/MM/yyyy"]))
    assert [r[0] for r in out.collect()] == [None, dt.datetime(2015, 2, 28), None, None]


def test_counts_sums_and_shares(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2)], "k string, v int")
    out = group_agg(
        df,
        ["k"],
        F.count("v").alias("present"),
        F.count(F.lit(1)).alias("n"),
        F.sum("v").alias("total"),
        missing_share("v").alias("share"),
    )
    assert rows(out) == [("a", 0, 2, None, 1.0), ("b", 1, 1, 2, 0.0)]


def test_describe_matches_pandas(spark):
    import pandas as pd

    values = [1.0, 4.0, 4.0, 7.0, 11.0, 12.0]
    df = spark.createDataFrame([("z", v) for v in values] + [("z", None), ("y", 3.0)], "k string, v double")
    names = {"p10": 0.1, "p50": 0.5, "p100": 1.0}
    out = {r["k"]: r.asDict() for r in describe(df, ["k"], "v", names).collect()}
    ref = pd.Series(values).describe(percentiles=[0.1, 0.5, 1])
    assert out["z"]["n"] == 6
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p10", "10%"),
                         ("p50", "50%"), ("p100", "100%"), ("max", "max")]:
        assert abs(out["z"][ours] - ref[theirs]) < 1e-12
    assert out["y"]["std"] is None


def test_later_zone_rules_override(spark):
    df = spark.createDataFrame(
        [("Local",), ("Regional Outlying",), ("Main Local",), ("National Main",), ("x",), (None,)],
        "z string",
    )
    assert [r[0] for r in df.select(classify_last_match("z")).collect()] == [
        "Local",
        "Post office/Post-Net",
        "Main",
        "Speed Services",
        None,
        None,
    ]


def test_waterfall_propagates_missing_stages(spark):
    df = spark.createDataFrame(
        [
            (1, "a", 10.0), (1, "b", 5.0), (1, "c", 2.0),
            (2, "b", 7.0),
            (3, "z", 9.0),
        ],
        "m int, s string, v double",
    )
    stages = {
        "a": F.col("s") == "a",
        "b": F.col("s").isin("a", "b"),
        "c": F.col("s").isin("a", "b", "c"),
    }
    out = waterfall(df, ["m"], F.col("v"), stages)
    # Month 2 has no first stage, so nothing after it is known; month 3 has no stage at all.
    assert rows(out) == [(1, 10.0, 5.0, 2.0), (2, None, None, None)]


def test_missing_stages_count_as_zero_on_request(spark):
    rows = spark.createDataFrame([("g", 5.0, False, True)], "g string, amount double, a boolean, b boolean")
    stages = {"first": F.col("a"), "second": F.col("b")}
    plain = waterfall(rows, ["g"], F.col("amount"), stages).first()
    zeros = waterfall(rows, ["g"], F.col("amount"), stages, missing_as_zero=True).first()
    assert (plain["first"], plain["second"]) == (None, None)
    assert (zeros["first"], zeros["second"]) == (0.0, 5.0)


def test_blank_keys_and_precedence(spark):
    df = spark.createDataFrame(
        [("", "", "P1"), (None, "E1", "P1"), ("B1", "E1", "P1"), ("", "E1", "P1")],
        "barcode string, ean string, sku string",
    )
    assert [r[0] for r in df.select(item_key("barcode", "ean", "sku")).collect()] == [
        "P1", "E1", "B1", "E1",
    ]
    assert rows(blanks_to_null(df), "barcode") == [(None,), (None,), (None,), ("B1",)]


def test_masked_assignment_ignores_unknown_condition(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "s string, v int")
    out = df.select(overwrite_where("v", F.col("s") == "a", 0))
    assert [r[0] for r in out.collect()] == [1, 0]


def test_drop_missing_rules(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", "c")], "x string, y string")
    assert rows(drop_missing(df, how="all")) == [("a", None), ("b", "c")]
    assert rows(drop_missing(df, ["y"])) == [("b", "c")]
    assert rows(drop_missing(df, ["x", "y"], min_present=1)) == [("a", None), ("b", "c")]

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators.dedupe import (
    attribute_to_first,
    flag_repeats,
    flag_repeats_bounded,
    keep_first,
    keep_last,
    nulls_last,
    reduce_partial_deliveries,
)
from tests.helpers import bag, plan_text, rows


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    data = [
        (i, rng.choice(["a", "b", "c", None, "hot", "hot", "hot"]), rng.choice([None, 1, 2, 3]))
        for i in range(400)
    ]
    return spark.createDataFrame(data, "seq long, k string, d int").cache()


def test_result_does_not_depend_on_partitioning(events):
    expected = bag(keep_first(events, ["k"], ["d", "seq"]))
    flags = bag(flag_repeats(events, ["k"], ["d", "seq"]))
    for n in (1, 7, 31):
        shuffled = events.repartition(n, F.rand(n))
        assert bag(keep_first(shuffled, ["k"], ["d", "seq"])) == expected
        assert bag(flag_repeats(shuffled, ["k"], ["d", "seq"])) == flags


def test_first_and_last_with_missing_keys_as_one_group(events):
    data = [tuple(r) for r in events.collect()]
    by_key = {}
    for seq, k, d in data:
        by_key.setdefault(k, []).append(((d is not None, d or 0, seq), (seq, k, d)))
    assert rows(keep_first(events, ["k"], ["d", "seq"])) == sorted(
        (min(v)[1] for v in by_key.values()), key=lambda r: [(x is not None, str(x)) for x in r]
    )
    assert rows(keep_last(events, ["k"], ["d", "seq"])) == sorted(
        (max(v)[1] for v in by_key.values()), key=lambda r: [(x is not None, str(x)) for x in r]
    )


def test_missing_order_values_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 3, 3)], "k string, d int, s int")
    assert rows(keep_first(df, ["k"], [nulls_last("d"), "s"])) == [("a", 3, 3)]
    assert rows(keep_first(df, ["k"], ["d", "s"])) == [("a", None, 1)]


def test_both_flag_forms_agree(events):
    order = [nulls_last("d"), "seq"]
    assert bag(flag_repeats(events, ["k"], order)) == bag(
        flag_repeats_bounded(events, ["k"], order)
    )
    assert flag_repeats(events, ["k"], order).filter("not is_repeat").count() == 5


def test_group_limit_runs_before_the_shuffle(events):
    text = plan_text(keep_first(events, ["k"], ["seq"]))
    assert text.index("Partial") > text.index("Exchange") > text.index("Final")
    assert "WindowGroupLimit" in text


def test_flagging_uses_no_window(events):
    assert "Window" not in plan_text(flag_repeats(events, ["k"], ["seq"]))


def test_attribution(spark):
    df = spark.createDataFrame(
        [
            (1, "x", 10, "Placed", False),
            (2, "x", 10, "Draft PO", False),
            (3, "x", 10, None, False),
            (4, "x", 10, "Draft PO", True),
            (5, "y", 20, "Draft PO", False),
            (6, None, 30, "Placed", False),
            (7, None, 30, "Placed", False),
            (0, "z", None, "Placed", True),
            (8, "z", 40, "Placed", False),
        ],
        "seq int, sku string, units int, status string, blank boolean",
    )
    out = attribute_to_first(
        df, "sku", ["seq"], F.col("blank"), ["units"], F.col("status").eqNullSafe("Draft PO")
    )
    assert rows(out, "seq", "units") == [
        (0, None), (1, 10), (3, None), (4, 10), (5, 20), (6, 30), (7, None), (8, 40),
    ]


def literal_reduction(df, id_col):
    """The three steps one after another, by windows."""
    def order(w):
        return w.orderBy(F.col("q").asc_nulls_last(), "seq")

    df = df.withColumn("r", F.row_number().over(order(Window.partitionBy(id_col, "q")))).filter("r = 1")
    df = df.withColumn("is_repeat", F.row_number().over(order(Window.partitionBy("po"))) > 1)
    df = df.withColumn("r", F.row_number().over(order(Window.partitionBy("po", F.col("q").isNotNull()))))
    return df.filter("r = 1").drop("r")


@pytest.mark.parametrize("id_col", ["conf", "po"])
def test_partial_deliveries_equal_the_literal_steps(spark, id_col):
    rng = random.Random(11)
    data = [
        (i, rng.choice("abcdef"), rng.choice(["1", "2", "3", "4", None, None]), rng.choice([None, 1, 2]))
        for i in range(120)
    ]
    df = spark.createDataFrame(data, "seq long, conf string, po string, q int")
    out = reduce_partial_deliveries(df, id_col, "po", "q", ["seq"])
    assert bag(out) == bag(literal_reduction(df, id_col))
    assert out.filter("po is null").count() <= 2

"""Spread order statistics against Spark's own percentile."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.aggregates import DECILES, QUARTILES, describe
from quayside.operators.quantiles import describe_spread, order_statistics, value_counts_by
from tests.helpers import plan_text, rows

NAMES = {f"p{round(100 * q)}": q for q in (0.0, *QUARTILES, *DECILES)}


@pytest.fixture(scope="module")
def measured(spark):
    draw = random.Random(3)
    data = [("hot", draw.uniform(-5, 5)) for _ in range(3000)]
    data += [("ties", float(draw.randint(0, 4))) for _ in range(500)]
    data += [("one", 7.5), ("two", 1.0), ("two", 2.0), ("none", None), (None, 3.0), ("hot", None), ("far", 1e9), ("far", 1e9 + 1e-3)]
    data += [("odd", float("inf")), ("odd", -0.0), ("odd", 0.0)]
    return spark.createDataFrame(data, "k string, v double").repartition(5)


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) <= 1e-9 * max(1, abs(a)))


@pytest.mark.parametrize("keys", [["k"], []])
def test_equal_to_the_buffered_form(measured, keys):
    data = measured.filter("k IS NULL OR k <> 'odd'")
    expected = rows(describe(data, keys, "v", NAMES, total="total"))
    found = rows(describe_spread(data, keys, "v", NAMES, total="total"))
    assert len(found) == len(expected) and len(found) == (6 if keys else 1)
    for a, b in zip(found, expected, strict=True):
        assert all(x == y if isinstance(x, str) else close(x, y) for x, y in zip(a, b, strict=True)), (a, b)


def test_quantiles_equal_percentile_to_the_bit(measured, tmp_path):
    at = list(NAMES.values())
    expected = measured.dropna(subset=["k"]).groupBy("k").agg(F.percentile("v", at).alias("p")).filter("p IS NOT NULL")
    found = order_statistics(value_counts_by(measured, ["k"], "v"), ["k"], NAMES, str(tmp_path / "q")).drop("_all")
    assert rows(found.select("k", F.array(*NAMES).alias("p"))) == rows(expected.select("k", "p"))


def test_no_task_holds_a_group(spark, measured, tmp_path, skewed_conf):
    """The hot group lies in many ranges, and only those that hold a wanted value are numbered."""
    counts = value_counts_by(measured, ["k"], "v")
    found = order_statistics(counts, ["k"], {"p50": 0.5}, str(tmp_path / "q"))
    dealt = spark.read.parquet(str(tmp_path / "q" / "ranges"))
    per = {r["_part"]: r["n"] for r in dealt.filter("k = 'hot'").groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(per) > 8 and max(per.values()) < 1000
    assert found.count() > 0 and "percentile" not in plan_text(found)


def test_an_empty_table_has_no_groups(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert rows(describe_spread(empty, ["k"], "v", {"p50": 0.5})) == []

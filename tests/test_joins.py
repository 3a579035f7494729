import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.joins import (
    fan_out_join,
    full_join_few,
    left_join,
    outer_chain,
    outer_join_filled,
    right_join,
    skew_join,
)
from tests.helpers import bag, plan_text, rows, run


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(5)
    keys = ["hot"] * 5 + ["a", "b", "c", "only-facts", None]
    return spark.createDataFrame([(rng.choice(keys), i) for i in range(300)], "k string, v int").cache()


@pytest.fixture(scope="module")
def dims(spark):
    data = [("hot", 1), ("hot", 2), ("a", 3), ("b", 4), ("only-dims", 5), (None, 6), (None, 7)]
    return spark.createDataFrame(data, "k string, w int").cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_join_equals_plain(facts, dims, how):
    assert bag(skew_join(facts, dims, "k", how)) == bag(facts.join(dims, "k", how))


def test_skew_join_refuses_other_kinds(facts, dims):
    with pytest.raises(ValueError):
        skew_join(facts, dims, "k", "full")


def test_fan_out_join_equals_plain_left_join(facts, dims):
    assert bag(fan_out_join(dims, facts, "k")) == bag(dims.join(facts, "k", "left"))


def test_right_join_equals_plain(facts, dims):
    assert bag(right_join(facts, dims, "k")) == bag(facts.join(dims, "k", "right"))


def test_outer_chain_equals_plain_full_joins(spark):
    rng = random.Random(9)
    frames = [
        spark.createDataFrame(
            [(rng.choice("abcdefgh"), rng.randint(0, 3)) for _ in range(6)], f"k string, s{i} int"
        )
        for i in range(4)
    ]
    plain = frames[0]
    for frame in frames[1:]:
        plain = plain.join(frame, "k", "full")
    assert bag(outer_chain(frames, "k")) == bag(plain)


def test_outer_join_fills_the_key(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "pid string, n int")
    b = spark.createDataFrame([("y", 5), ("z", 6)], "sku string, m int")
    assert rows(outer_join_filled(a, b, "pid", "sku", "sku"), "sku", "n", "m") == [
        ("x", 1, None), ("y", 2, 5), ("z", None, 6),
    ]


def skewed(spark):
    """A third of the rows on one key, and dims that are aggregated by that key."""
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    dims = facts.groupBy("k").agg(F.max("v").alias("top"))
    return facts, dims


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_split_at_run_time(spark, skewed_conf, how):
    facts, dims = skewed(spark)
    df = skew_join(facts, dims, "k", how)
    assert run(df) == 60_000
    assert "skew=true" in plan_text(df)


def test_a_hot_key_in_a_chain_is_split(spark, skewed_conf):
    facts, _ = skewed(spark)
    others = [
        spark.range(0, 60_000, 7 + i, 8).select(F.col("id").cast("string").alias("k"), F.lit(i).alias(f"w{i}"))
        for i in range(2)
    ]
    expected = facts.select("k").unionByName(others[0].select("k")).unionByName(others[1].select("k"))
    only_others = expected.distinct().join(facts, "k", "left_anti").count()
    df = outer_chain([facts, *others], "k")
    assert run(df) == 60_000 + only_others
    assert "skew=true" in plan_text(df)


def test_a_hot_key_on_the_right_is_split(spark, skewed_conf):
    facts, dims = skewed(spark)
    plain = dims.join(facts, "k", "left")
    run(plain)
    assert "skew=true" not in plan_text(plain)  # a left join is never split on its right
    df = fan_out_join(dims, facts, "k")
    assert run(df) == 60_000
    assert "skew=true" in plan_text(df)


def test_hot_dims_are_split_in_both_joins(spark, skewed_conf):
    """Without `present`, the mark is joined by a splittable join as well."""
    facts, dims = skewed(spark)
    df = fan_out_join(facts, dims, "k")
    assert run(df) == 60_000
    assert plan_text(df).count("skew=true") >= 2


def test_full_join_few_equals_a_full_join_and_is_split(spark, skewed_conf):
    facts, dims = skewed(spark)
    many = facts.filter(F.col("v") % 5 != 1)
    found = full_join_few(many, dims, "k")
    plain = many.join(dims, "k", "full").select(*found.columns)
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0
    run(found)
    assert "skew=true" in plan_text(found)


def test_missing_keys_match_on_request(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([(None, 7)], "k string, w int")
    rows = lambda df: sorted((r.v, r.w) for r in df.collect())
    assert rows(left_join(a, b, "k")) == [(1, None), (2, None)]
    assert rows(left_join(a, b, "k", null_safe=True)) == [(1, None), (2, 7)]
    assert left_join(a, b, ["k"], null_safe=True).columns == ["k", "v", "w"]

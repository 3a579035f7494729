"""New rows by a Bloom filter, and tables that meet in their buckets."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.membership import bloom_words, consolidated, may_hold, new_rows, row_key
from quayside.operators.setops import consolidate
from quayside.sources.colocated import Layout, nightly_line_facts, read_colocated, write_colocated, write_nightly
from tests.helpers import bag, plan_text, rows

SCHEMA = "product_id string, day int, n long"


def drawn(spark, seed, count):
    draw = random.Random(seed)
    data = [(draw.choice([None, *"abcdefgh"]), draw.choice([None, 1, 2, 3]), draw.randint(0, 20)) for _ in range(count)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("bits", [1 << 23, 64])
def test_equal_to_distinct_over_everything(spark, bits):
    history = consolidate([drawn(spark, 1, 300)], "product_id")
    day = drawn(spark, 2, 200)
    assert bag(consolidated(history, day, "product_id", bits)) == bag(consolidate([history, day], "product_id"))
    fresh = {tuple(r) for r in day.collect()} - {tuple(r) for r in history.collect()}
    assert rows(new_rows(history, day, bits)) == sorted(fresh, key=lambda r: [(v is not None, str(v)) for v in r])
    assert new_rows(history.limit(0), day).count() == day.distinct().count()
    assert new_rows(history, day.limit(0)).count() == 0


def test_the_filter_never_refuses_a_key_it_has(spark):
    keys = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    words = bloom_words(keys, row_key(["k"]), 1 << 16)
    assert keys.filter(may_hold(words, row_key(["k"]), 1 << 16)).count() == 5000
    others = spark.range(5000, 25_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    assert others.filter(may_hold(words, row_key(["k"]), 1 << 16)).count() < 2000


def test_the_filter_stands_above_the_scan_of_the_history(spark, tmp_path):
    spark.range(2000).select(F.col("id").cast("string").alias("product_id"), F.lit(1).alias("day"), F.col("id").alias("n")).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    out = new_rows(history, drawn(spark, 3, 5))
    lines = plan_text(out).split("\n")  # as planned: run, a history without a match is left out altogether
    at = next(i for i, line in enumerate(lines) if "Filter" in line and "shiftright" in line)
    depth = lines[at].index("Filter")
    child = next(line for line in lines[at + 1 :] if line[depth : depth + 3] == "+- ")
    assert "FileScan parquet" in child or "ColumnarToRow" in child
    assert out.count() == len({tuple(r) for r in drawn(spark, 3, 5).collect()})


LAYOUT = Layout(("sku", "pos"), 8)


def test_tables_meet_without_an_exchange(spark, tmp_path, skewed_conf):
    draw = random.Random(8)
    key = lambda: (draw.choice([None, *"abcdef"]), draw.choice([None, *"123456"]))
    lines = spark.createDataFrame([(*key(), "r", "Placed", draw.randint(1, 9)) for _ in range(200)], "sku string, pos string, ref string, status string, bp_qty int")
    counts = spark.createDataFrame([(*key(), draw.randint(1, 9), None) for _ in range(200)], "sku string, pos string, qty_counted long, qc_date date")
    receipts = spark.createDataFrame([(*key(), draw.randint(1, 9), None) for _ in range(100)], "sku string, pos string, quantity_received long, received_date date")
    root = str(tmp_path)
    for _ in range(2):  # a rerun replaces the tables
        write_nightly(root, lines, counts, receipts, LAYOUT)
    found = nightly_line_facts(spark, root, LAYOUT)
    found.collect()
    assert "Exchange" not in plan_text(found) and "SortMergeJoin" in plan_text(found)
    keys = ["sku", "pos"]
    present = lambda df: df.dropna(subset=keys)
    expected = (
        present(lines).groupBy("sku", "pos", "ref", "status").agg(F.sum("bp_qty").alias("bp_qty"))
        .join(present(counts).groupBy(*keys).agg(F.sum("qty_counted").alias("qty_counted"), F.max("qc_date").alias("last_qced")), keys, "left")
        .join(present(receipts).groupBy(*keys).agg(F.sum("quantity_received").alias("qty_received"), F.max("received_date").alias("last_received")), keys, "left")
    )
    assert bag(found) == bag(expected)


def test_buckets_grow_with_the_rows(spark, tmp_path, skewed_conf):
    make = lambda n, *more: spark.range(n).select(F.col("id").cast("string").alias("sku"), (F.col("id") % 7).cast("string").alias("pos"), *more)
    lines = make(400, F.lit("r").alias("ref"), F.lit("Placed").alias("status"), F.lit(2).alias("bp_qty"))
    counts = make(300, F.lit(3).alias("qty_counted"), F.current_date().alias("qc_date"))
    receipts = make(100, F.lit(4).alias("quantity_received"), F.current_date().alias("received_date"))
    root, buckets = str(tmp_path), lambda: {f.name.split("_")[1].split(".")[0] for f in (tmp_path / "colocated=lines").glob("*.parquet")}
    facts = lambda: bag(nightly_line_facts(spark, root, LAYOUT), ["sku", "bp_qty", "qty_counted", "qty_received"])
    expected = {(str(i), 2, 3 if i < 300 else None, 4 if i < 100 else None): 1 for i in range(400)}
    for limit, least, most in ((40, 16, 20), (10**6, 1, 8), (40, 16, 20)):  # more buckets, then few again
        write_nightly(root, lines, counts, receipts, LAYOUT, rows_per_bucket=limit)
        assert least <= len(buckets()) <= most and facts() == expected
    found = nightly_line_facts(spark, root, LAYOUT)
    assert "Exchange" not in plan_text(found) and found.rdd.getNumPartitions() == 20
    (tmp_path / "_buckets").write_text("0")
    (tmp_path / "._buckets.crc").unlink()
    with pytest.raises(ValueError, match="not written to the end"):
        nightly_line_facts(spark, root, LAYOUT)


def test_another_session_knows_the_buckets(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("sku"), F.lit("1").alias("pos"))
    write_colocated(df, str(tmp_path / "t"), LAYOUT)
    spark.sql("DROP TABLE IF EXISTS " + next(t.name for t in spark.catalog.listTables() if t.name.startswith("colocated_")))
    again = read_colocated(spark, str(tmp_path / "t"), "sku string, pos string", LAYOUT)
    assert again.count() == 100
    grouped = again.groupBy("sku", "pos").count()
    assert "Exchange" not in plan_text(grouped)

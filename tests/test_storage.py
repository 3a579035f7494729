"""Sources, sinks and the scan drain."""

import datetime as dt
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quayside.operators.predicates import drop_missing
from quayside.operators.sorting import sort_keys
from quayside.session import scratch_path
from quayside.sources import schemas
from quayside.sources.delimited import (
    booking_rejects,
    read_booking_export,
    read_delimited,
    read_sheet,
    read_state_file,
)
from quayside.sources.sinks import (
    append_state,
    expire_state,
    materialize,
    read_state,
    replace_partition,
    write_delimited,
    write_ordered,
    write_per_value,
    write_report,
)
from quayside.sources.tables import (
    JdbcSplit,
    jdbc_options,
    read_history_dir,
    read_snapshot,
    read_table,
    unreadable_files,
)
from quayside.streaming.scans import drain_scans
from tests.helpers import plan_text, rows


def test_latin1_text_and_column_subset(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("sku,pos,name\nP1,1,Blüte\n".encode("latin-1"))
    df = read_delimited(spark, str(tmp_path), "sku string, pos string, name string", ["pos", "name"])
    assert rows(df) == [("1", "Blüte")]
    assert "ReadSchema: struct<pos:string,name:string>" in plan_text(df)


def test_booking_export_with_preamble_and_line_breaks(spark, tmp_path):
    text = (
        '"Bookings report"\n"Date","Time","Event","Client","Mail","Cancelled","Recorded","Fields"\n'
        '"05/06/2015","08:00","E","c","m","No","2015-06-01 10:00","POs: 1\n2"\n"",,,,,,,\n'
    )
    (tmp_path / "a.csv").write_text(text)
    df = read_booking_export(spark, str(tmp_path), schemas.BOOKING_EXPORT)
    assert rows(df, "date", "event", "additional_fields") == [(dt.date(2015, 6, 5), "E", "POs: 1\n2")]


def test_state_file_day_first(spark, tmp_path):
    (tmp_path / "a.txt").write_text("date;pos;sku;reason;responsible\n03/04/2015;1;P1;torn, dirty;q\nbad;2;P2;x;q\n")
    df = read_state_file(spark, str(tmp_path), schemas.ROLLING_DAMAGES, ["date"])
    assert rows(df, "date", "reason") == [(None, "x"), (dt.datetime(2015, 4, 3), "torn, dirty")]


def test_header_only_state_and_sheet_are_empty_but_typed(spark, tmp_path):
    (tmp_path / "a.txt").write_text("date;supplier;po;sku;oversupply\n")
    df = read_state_file(spark, str(tmp_path), schemas.ROLLING_OVERSUPPLY, ["date"])
    assert df.count() == 0 and df.dtypes[0] == ("date", "timestamp")
    sheet = read_sheet(spark, str(tmp_path), ["product_id", "reason"])
    assert sheet.count() == 0 and [t for _, t in sheet.dtypes] == ["string", "string"]


def test_blank_cells_are_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n"",x\ny,\n')
    assert rows(read_sheet(spark, str(tmp_path), ["a", "b"])) == [(None, "x"), ("y", None)]
    assert rows(drop_missing(read_sheet(spark, str(tmp_path), ["a", "b"]), ["a"])) == [("y", None)]


def test_history_skips_unreadable_files_and_names_them(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.createDataFrame([("A", 1)], "product_id string, n int").coalesce(1).write.parquet(path)
    spark.createDataFrame([("B", 2, "x")], "product_id string, n int, team string").coalesce(1).write.mode(
        "append"
    ).parquet(path)
    (tmp_path / "h" / "broken.parquet").write_text("this is no parquet file")
    schema = "product_id string, n int, team string"
    with pytest.raises(Exception, match="broken|not a Parquet"):
        read_history_dir(spark, path, schema).collect()
    kept = read_history_dir(spark, path, schema, skip_unreadable=True)
    assert rows(kept) == [("A", 1, None), ("B", 2, "x")]
    kept = read_history_dir(spark, path, skip_unreadable=True)
    assert rows(kept, "product_id", "team") == [("A", None), ("B", "x")]
    assert [r[0].rsplit("/", 1)[1] for r in unreadable_files(spark, path).collect()] == ["broken.parquet"]


def test_a_file_damaged_in_the_middle_is_left_out_whole(spark, tmp_path):
    path, schema = str(tmp_path / "h"), "id bigint, text string"
    many = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    many.coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(path)
    damaged = next((tmp_path / "h").glob("*.parquet"))
    content = bytearray(damaged.read_bytes())
    middle = len(content) // 2
    content[middle : middle + 5000] = b"\xff" * 5000
    damaged.write_bytes(content)
    for crc in (tmp_path / "h").glob(".*.crc"):
        crc.unlink()
    spark.createDataFrame([(1, "x")], schema).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(Exception):  # noqa: B017
        read_history_dir(spark, path, schema).collect()
    assert rows(read_history_dir(spark, path, schema, skip_unreadable=True)) == [(1, "x")]
    assert [r.path.rsplit("/", 1)[1] for r in unreadable_files(spark, path).collect()] == [damaged.name]


def test_a_booking_with_a_mistyped_date_is_no_title(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        '"Bookings 2015"\n"Date","Time","Event","Client","Mail","Cancelled","Recorded","Fields"\n'
        '"05/06/2015","08:00","E","c","m","No","","POs: 1"\n"45/06/2015","08:00","F","c","m","No","","POs: 2"\n,,,,,,,\n'
    )
    with pytest.raises(Exception, match="no day-first date"):
        read_booking_export(spark, str(tmp_path), schemas.BOOKING_EXPORT).collect()
    df = read_booking_export(spark, str(tmp_path), schemas.BOOKING_EXPORT, skip_rejects=True)
    assert rows(df, "event") == [("E",)]
    assert rows(booking_rejects(spark, str(tmp_path), schemas.BOOKING_EXPORT), "date", "event") == [("45/06/2015", "F")]


def test_a_booking_whose_date_is_a_word_is_a_reject(spark, tmp_path):
    head = '"Bookings","of 2015"\n\n"Date","Time","Event","Client","Mail","Cancelled","Recorded","Fields"\n'
    (tmp_path / "a.csv").write_text(head + 'tomorrow,b\n05/06/2015,08:00,E,c,m,No,,POs: 1\n,09:00,F\nlone cell\n')
    (tmp_path / "b.csv").write_text("05/06/2015,08:00,G\n")  # a file without a header
    assert rows(booking_rejects(spark, str(tmp_path), schemas.BOOKING_EXPORT), "date", "time") == [(None, "09:00"), ("tomorrow", "b")]
    kept = read_booking_export(spark, str(tmp_path), schemas.BOOKING_EXPORT, skip_rejects=True)
    assert rows(kept, "event") == [("E",), ("G",)]
    with pytest.raises(Exception, match="no day-first date"):
        read_booking_export(spark, str(tmp_path), schemas.BOOKING_EXPORT).collect()


def test_ordered_files_follow_each_other(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"), F.when(F.col("id") % 10 > 0, F.col("id") % 13).alias("k")).repartition(5)
    order = sort_keys(["k", "n"], descending=["k"], nulls="first")
    write_ordered(df, str(tmp_path / "o"), order, rows_per_file=100)
    found = [r for f in sorted((tmp_path / "o").glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
    assert found == df.orderBy(*order).collect() and len(list((tmp_path / "o").glob("*.parquet"))) == 10
    write_report(str(tmp_path), "r", {"t": df, "u": df}, dt.date(2015, 6, 5), {"t": order})
    assert spark.read.parquet(str(tmp_path / "report=r" / "tab=t")).count() == 1000


def test_many_ordered_files_come_from_few_ranges(spark, tmp_path):
    df = spark.range(6000).select((F.col("id") * 7919 % 6000).alias("n"), F.when(F.col("id") % 10 > 0, F.col("id") % 1009).alias("k")).repartition(5)
    order = sort_keys(["k", "n"], descending=["k"], nulls="first")
    write_ordered(df, str(tmp_path / "o"), order, rows_per_file=2)
    files = sorted((tmp_path / "o").glob("*.parquet"))
    found = [r for f in files for r in zip(*pq.read_table(f).to_pydict().values(), strict=True)]
    assert found == [tuple(r) for r in df.orderBy(*order).collect()]
    assert 3000 <= len(files) <= 3200 and len({f.name.split("-")[1] for f in files}) <= 200


def test_a_day_corrected_to_nothing_is_emptied(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "n int, date date"
    for day in (4, 5):
        replace_partition(spark.createDataFrame([(day, dt.date(2015, 6, day))], schema), path, date=dt.date(2015, 6, day))
    replace_partition(spark.createDataFrame([], schema), path, date=dt.date(2015, 6, 4))
    assert rows(read_state(spark, path, schema)) == [(5, dt.date(2015, 6, 5))]


def test_relational_options_come_from_conf(spark):
    spark.conf.set("spark.quayside.jdbc.url", "jdbc:example:")
    try:
        options = jdbc_options(spark, "items", JdbcSplit("id", "0", "100", 8))
    finally:
        spark.conf.unset("spark.quayside.jdbc.url")
    assert options == {
        "url": "jdbc:example:", "dbtable": "items", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }


def test_table_and_snapshot_read_only_named_columns(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("2015-06-05 10:00:00", 1), ("no date", 2)], "d string, n int").write.parquet(path)
    assert rows(read_table(spark, path, ["d"], ["d"])) == [(None,), (dt.datetime(2015, 6, 5, 10),)]
    df = read_snapshot(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey"])
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan_text(df)


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a;b", 'say "x"', None)], "x string, y string, z string")
    write_delimited(df, str(tmp_path / "o"))
    back = read_delimited(spark, str(tmp_path / "o"), "x string, y string, z string", sep=";", encoding="UTF-8")
    assert rows(back) == rows(df)


def test_one_sub_report_per_buyer(spark, tmp_path):
    df = spark.createDataFrame([("u", 1), ("v", 2), (None, 3), ("u", 4)], "buyer string, n int")
    write_per_value(df, str(tmp_path / "b"), "buyer")
    assert sorted(p.name for p in (tmp_path / "b").glob("buyer=*")) == ["buyer=u", "buyer=v"]
    assert spark.read.parquet(str(tmp_path / "b")).count() == 3


def test_rerun_replaces_only_that_day(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "n int")
    two = spark.createDataFrame([(2,), (3,)], "n int")
    write_report(str(tmp_path), "r", {"t": one}, dt.date(2015, 6, 4))
    write_report(str(tmp_path), "r", {"t": one}, dt.date(2015, 6, 5))
    write_report(str(tmp_path), "r", {"t": two}, dt.date(2015, 6, 5))
    got = spark.read.parquet(str(tmp_path / "report=r")).groupBy("as_of").count()
    assert rows(got) == [(dt.date(2015, 6, 4), 1), (dt.date(2015, 6, 5), 2)]


def test_state_is_appended_and_pruned_by_date(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "n int, date date"
    for day in (4, 5, 5):  # the rerun of a day changes nothing
        append_state(spark.createDataFrame([(day, dt.date(2015, 6, day))], schema), path, "date")
    df = read_state(spark, path, schema).filter(F.col("date") >= dt.date(2015, 6, 5))
    assert rows(df) == [(5, dt.date(2015, 6, 5))]
    assert "PartitionFilters: [isnotnull(date" in plan_text(df)
    assert expire_state(spark, path, "date", dt.date(2015, 6, 5)) == ["2015-06-04"]
    assert rows(read_state(spark, path, schema)) == [(5, dt.date(2015, 6, 5))]


def test_materialize_cuts_the_plan(spark, tmp_path):
    df = spark.range(5).groupBy().count()
    back = materialize(df, str(tmp_path / "m"))
    assert rows(back) == [(5,)] and "Aggregate" not in plan_text(back)


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    conf = {"spark.checkpoint.dir": "hdfs://shared/scratch/"}
    cluster = SimpleNamespace(conf=conf)
    assert scratch_path(cluster, "x").startswith("hdfs://shared/scratch/x-")


def test_drain_consumes_each_file_once(spark, tmp_path):
    inbox, history, checkpoint = (str(tmp_path / n) for n in ("inbox", "history", "checkpoint"))

    def scan(name, *codes):
        (tmp_path / "inbox").mkdir(exist_ok=True)
        (tmp_path / "inbox" / name).write_text("product_id,reason,responsible\n" + "".join(f"{c},r,q\n" for c in codes))

    def drain(shift):
        drain_scans(spark, inbox, history, checkpoint, schemas.DAMAGE_SHEET, "product_id", shift=shift)
        return spark.read.parquet(history).count()

    scan("1.csv", "a1", "b2")
    assert drain("one") == 2
    assert drain("two") == 2
    scan("2.csv", "c3", "")
    assert drain("three") == 3
    assert rows(spark.read.parquet(history), "product_id", "shift") == [
        ("A1", "one"), ("B2", "one"), ("C3", "three"),
    ]


@pytest.mark.parametrize("label", ["a", "b"])
def test_scratch_paths_are_fresh(spark, label):
    assert scratch_path(spark, label) != scratch_path(spark, label)

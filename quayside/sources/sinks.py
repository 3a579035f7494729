"""Report and state writers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import remove_path, scratch_path
from quayside.sources import files


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """`;`-separated UTF-8 text with a header, one file per task."""
    (
        df.write.mode("overwrite")
        .option("sep", sep)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .csv(path)
    )


def write_per_value(df: DataFrame, path: str, column: str) -> None:
    """One sub-report per value of a column, in one job; rows without one are left out.

    The rebalance hint groups each value's rows into few files and lets adaptive
    execution cut a value that is too large for one task.
    """
    kept = df.filter(F.col(column).isNotNull()).hint("rebalance", column)
    kept.write.mode("overwrite").partitionBy(column).parquet(path)


def write_report(
    root: str,
    name: str,
    tabs: Mapping[str, DataFrame],
    as_of: date,
    orders: Mapping[str, Sequence[Column]] | None = None,
) -> dict[str, str]:
    """Write the tables of one report; a rerun for the same day replaces that day only.

    Tabs named in `orders` are written by `write_ordered`.
    """
    paths = {}
    for tab, df in tabs.items():
        path = f"{root.rstrip('/')}/report={name}/tab={tab}/as_of={as_of.isoformat()}"
        if orders and tab in orders:
            write_ordered(df, path, orders[tab])
        else:
            df.write.mode("overwrite").parquet(path)
        paths[tab] = path
    return paths


# Ranges that rows are dealt into where files are many: a task writes several files then, and there are no more
# tasks than rows need, as dealing costs a block per task that reads and range.
SINGLE_RANGES = 200
ROWS_PER_RANGE = 1_000_000
# A file's number in its name has three digits; ranges are estimates, hence half of what these can count.
FILES_PER_RANGE = 500


def write_ordered(
    df: DataFrame, path: str, order: Sequence[Column], rows_per_file: int = 1_000_000
) -> None:
    """Files in the order of their names, each sorted: reading them one after another gives the report in order.

    The rows are dealt by ranges of the sort keys, so no task holds more than a range. A range is a file as long as
    ranges are few, else it is cut into files of `rows_per_file`. Plans leave their rows unordered, so that a table
    that is read on, joined or aggregated is never sorted for nothing.
    """
    spark, scratch = df.sparkSession, scratch_path(df.sparkSession, "ordered")
    rows = materialize(df, scratch)  # dealing by ranges reads its input twice
    n = rows.count()
    files_ = max(1, -(-n // rows_per_file))
    ranges = min(files_, max(SINGLE_RANGES, -(-n // ROWS_PER_RANGE), -(-files_ // FILES_PER_RANGE)))
    writer = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).write.mode("overwrite")
    if ranges < files_:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    remove_path(spark, scratch)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back, so that several reports share one computation."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_state(df: DataFrame, path: str, *partition: str) -> None:
    """Write the partitions that `df` holds; a rerun replaces them and leaves all others as they are.

    A partition that `df` has no rows for stays; `replace_partition` empties it.
    """
    writer = df.hint("rebalance", *partition).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def replace_partition(df: DataFrame, path: str, **values: object) -> None:
    """Write `df` as the whole content of one partition, which goes if there are no rows.

    `values` name the partition, in the order of its folders; rows hold no such columns or equal ones.
    """
    folder = "/".join([path.rstrip("/"), *(f"{name}={value}" for name, value in values.items())])
    spark, rows = df.sparkSession, df.drop(*values)
    beside = scratch_path(spark, "partition")
    if materialize(rows, beside).isEmpty():
        files.delete(spark, folder)
    else:
        spark.read.schema(rows.schema).parquet(beside).write.mode("overwrite").parquet(folder)
    remove_path(spark, beside)


def expire_state(spark: SparkSession, path: str, partition: str, first: date) -> list[str]:
    """Remove the partitions of dates before `first`, without reading them; returns their names."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for entry in store.listStatus(root):
        name, _, value = entry.getPath().getName().partition("=")
        if name == partition and re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) and value < first.isoformat():
            store.delete(entry.getPath(), True)
            gone.append(value)
    return sorted(gone)


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)

"""Tables stored in buckets by key, so that those with equal buckets meet without a shuffle."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.aggregates import group_agg
from quayside.sources import files

# Rows of all tables of one layout that a bucket, and so a task, should hold.
ROWS_PER_BUCKET = 500_000

# A small file beside the tables of a night with their number of buckets, 0 while they are written.
BUCKETS = "_buckets"


@dataclass(frozen=True)
class Layout:
    """The columns by whose hash rows are dealt, and the number of buckets. Tables of one layout can be joined by it.

    A bucket is one task, which no adaptive execution can split. So the columns should be those by which rows are
    unique or nearly so: item and PO rather than the item alone, of which one may hold most rows.
    """

    columns: tuple[str, ...]
    buckets: int = 256


def fitted(layout: Layout, tables: list[DataFrame], rows_per_bucket: int = ROWS_PER_BUCKET) -> Layout:
    """The layout with at least as many buckets as the tables' rows need, so that a bucket stays as large while they grow."""
    rows = sum(df.count() for df in tables)
    return replace(layout, buckets=max(layout.buckets, -(-rows // rows_per_bucket)))


def _name(path: str, layout: Layout) -> str:
    """A name for each number of buckets, as a session may still know the table with an earlier one."""
    return f"colocated_{hashlib.sha256(path.encode()).hexdigest()[:20]}_{layout.buckets}"


def write_colocated(df: DataFrame, path: str, layout: Layout) -> None:
    """Write one file per bucket, sorted by the layout's columns."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path, layout)}")
    dealt = df.repartition(layout.buckets, *layout.columns)
    writer = dealt.write.mode("overwrite").bucketBy(layout.buckets, *layout.columns).sortBy(*layout.columns)
    writer.option("path", path).saveAsTable(_name(path, layout))


def read_colocated(spark: SparkSession, path: str, schema: str, layout: Layout) -> DataFrame:
    """The table at `path` with its layout known, in whichever session and without a catalog that lasts."""
    keys = ", ".join(layout.columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(path, layout)} ({schema}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {layout.buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(_name(path, layout))


def by_layout(df: DataFrame, layout: Layout, *measures: Column) -> DataFrame:
    """One row per value of the layout's columns; buckets are aggregated where they lie."""
    return group_agg(df, list(layout.columns), *measures)


ITEM_PO = Layout(("sku", "pos"))
LINES = "sku string, pos string, ref string, status string, bp_qty bigint"
COUNTED = "sku string, pos string, qty_counted bigint, qc_date date"
RECEIVED = "sku string, pos string, quantity_received bigint, received_date date"


def write_nightly(
    root: str, lines: DataFrame, counts: DataFrame, receipts: DataFrame, layout: Layout = ITEM_PO, rows_per_bucket: int = ROWS_PER_BUCKET
) -> None:
    """The (item, PO) tables of a night, each with the columns of its schema above.

    `layout` gives the least number of buckets; many rows get more, which `nightly_line_facts` finds noted.
    """
    spark, root = lines.sparkSession, root.rstrip("/")
    tables = {}
    for name, df, schema in (("lines", lines, LINES), ("counts", counts, COUNTED), ("receipts", receipts, RECEIVED)):
        tables[name] = df.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])
    layout = fitted(layout, list(tables.values()), rows_per_bucket)
    files.write_text(spark, f"{root}/{BUCKETS}", "0")
    for name, df in tables.items():
        write_colocated(df, f"{root}/colocated={name}", layout)
    files.write_text(spark, f"{root}/{BUCKETS}", str(layout.buckets))


def _written(spark: SparkSession, root: str, layout: Layout) -> Layout:
    """The layout with the number of buckets that is noted; without a note, as given."""
    if not files.exists(spark, f"{root}/{BUCKETS}"):
        return layout
    buckets = int(files.read_text(spark, f"{root}/{BUCKETS}"))
    if not buckets:
        raise ValueError(f"the tables at {root} were not written to the end")
    return replace(layout, buckets=buckets)


def nightly_line_facts(spark: SparkSession, root: str, layout: Layout = ITEM_PO) -> DataFrame:
    """Line groups per (item, PO, reference, status) with what was counted and taken in, without a shuffle."""
    root = root.rstrip("/")
    layout = _written(spark, root, layout)
    at = lambda name, schema: read_colocated(spark, f"{root}/colocated={name}", schema, layout)
    groups = group_agg(at("lines", LINES), ["sku", "pos", "ref", "status"], F.sum("bp_qty").alias("bp_qty"))
    counted = by_layout(at("counts", COUNTED), layout, F.sum("qty_counted").alias("qty_counted"), F.max("qc_date").alias("last_qced"))
    taken = by_layout(at("receipts", RECEIVED), layout, F.sum("quantity_received").alias("qty_received"), F.max("received_date").alias("last_received"))
    keys = list(layout.columns)
    return groups.join(counted, keys, "left").join(taken, keys, "left")

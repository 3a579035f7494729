"""Relational views, snapshot tables and history directories."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.calendar import parse_timestamp
from quayside.sources.history import check_files, listed_files

# Text forms of a date that a relational view may hand over.
VIEW_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


@dataclass(frozen=True)
class JdbcSplit:
    """How to cut a relational read into parallel ranges."""

    column: str
    lower: str
    upper: str
    partitions: int

    @property
    def whole(self) -> bool:
        return self.partitions == 1


# A read over one connection, for views of a known small size.
WHOLE = JdbcSplit("", "", "", 1)


def jdbc_options(
    spark: SparkSession, table: str, split: JdbcSplit | None = None
) -> dict[str, str]:
    """Options of a relational read. Connection details come from Spark conf only."""
    names = ("url", "driver", "user", "password", "fetchsize")
    found = {n: spark.conf.get(f"spark.quayside.jdbc.{n}", None) for n in names}
    options = {n: v for n, v in found.items() if v}
    options["dbtable"] = table
    if split and not split.whole:
        options.update(
            partitionColumn=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=str(split.partitions),
        )
    return options


def read_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    date_cols: Sequence[str] = (),
    split: JdbcSplit | None = None,
) -> DataFrame:
    """Import a relational view, parsing the named text columns as dates.

    With `spark.quayside.jdbc.url` set the view is read over JDBC in the parallel ranges of `split`, which is then
    required: `WHOLE` reads a small view over one connection. Otherwise `name` is a parquet path.
    """
    if spark.conf.get("spark.quayside.jdbc.url", None):
        if split is None:
            raise ValueError(f"{name} needs a split: without one, a single task reads the whole view")
        df = spark.read.format("jdbc").options(**jdbc_options(spark, name, split)).load()
    else:
        df = spark.read.parquet(name)
    if columns:
        df = df.select(*columns)
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.withColumns(
        {c: parse_timestamp(c, VIEW_DATE_FORMATS) for c in date_cols if c in text}
    )


def read_snapshot(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Column subset of a snapshot table; the subset reaches the scan."""
    return spark.read.parquet(path).select(*columns)


def read_history_dir(
    spark: SparkSession, path: str, schema: str | None = None, skip_unreadable: bool = False
) -> DataFrame:
    """All history files of a directory. A file that cannot be read whole is an error.

    With `skip_unreadable` such a file is left out altogether, also the part of it that could be
    read; `unreadable_files` lists what was left out. Columns that a file lacks are NULL. A
    given schema saves the scan over all footers.
    """
    reader = spark.read.option("ignoreCorruptFiles", skip_unreadable)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    found = reader.parquet(path)
    if not skip_unreadable:
        return found
    bad = unreadable_files(spark, path, schema).select(F.col("path").alias("_bad"))
    located = found.withColumn("_from", F.col("_metadata.file_path"))
    return located.join(bad, F.col("_from") == F.col("_bad"), "left_anti").drop("_from")


def unreadable_files(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """(path, reason) of the files of a history directory that cannot be decoded to their last row.

    Valid files without rows are no fault. `history.checked_files` keeps the verdicts and checks new files only.
    """
    paths = [r.path for r in listed_files(spark, path).select("path").collect()]
    found = check_files(spark, paths, schema).filter("reason IS NOT NULL")
    named = listed_files(spark, path).select("path", "name")
    return found.join(named, "path").select(F.col("name").alias("path"), "reason")

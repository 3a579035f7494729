"""Delimited text with line breaks inside quotes, read by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, block, line, record): the records of all files below `path`, which quoted line breaks do not end.

    Files are cut into blocks of `spark.sql.files.maxPartitionBytes` and each is read by a task of its own. A line
    begins inside a quoted cell if the quotes before it are odd in number: those of the file's earlier
    blocks, which one running sum per file gives, and those of earlier lines in the block. Lines that begin inside
    one belong to the record of the last line that does not, wherever that is. Block and line place a record in its file.

    Quotes stand around cells or doubled inside them; a lone one in a plain cell would pair with the
    next. A quote that is never closed makes one record of the rest of its file. A `\\r` before a line break goes.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Tells only which line of a block comes first.
        F.monotonically_increasing_id().alias("line"),
        F.regexp_replace("value", "\r$", "").alias("text"),
        (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("quotes"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("line")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("odd", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    # Of a block: whether its quotes are odd in number, and its last line to begin a record, if the block does
    # not begin inside a cell (0) or if it does (1).
    ends = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("flips"),
        F.max(F.when(F.col("odd") == 0, F.col("line"))).alias("last0"),
        F.max(F.when(F.col("odd") == 1, F.col("line"))).alias("last1"),
    )
    # A row per block of a file.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    last = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    ends = ends.withColumn("last", F.when(last.isNotNull(), F.struct("block", last.alias("line"))))
    ends = ends.withColumn("open", F.last("last", ignorenulls=True).over(before)).select("file", "block", "inside", "open")
    placed = lines.join(ends, ["file", "block"]).withColumn("begins", F.col("odd") == F.col("inside"))
    here = F.when(F.col("begins"), F.struct("block", "line"))
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("start", F.coalesce(F.last(here, ignorenulls=True).over(so_far), F.col("open")))
    whole = F.col("begins") & (F.col("quotes") % 2 == 0)  # most records are a line
    alone = placed.filter(whole).select("file", "block", "line", F.col("text").alias("record"))
    parts = placed.filter(~whole).groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("parts"))
    joined = parts.select("file", "start.block", "start.line", F.array_join("parts.text", "\n").alias("record"))
    return alone.unionByName(joined)


def quoted_rows(spark: SparkSession, path: str, schema: str, sep: str = ",", quote: str = '"') -> DataFrame:
    """The cells of `quoted_records` as columns of `schema`, after file, block and line. Lines without text are no rows.

    The rows of the `multiLine` reader, whose tasks read a file each.
    """
    options = {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE"}
    found = quoted_records(spark, path, quote).filter(F.col("record") != "")
    return found.select("file", "block", "line", F.from_csv("record", schema, options).alias("_r")).select("file", "block", "line", "_r.*")


def place() -> Column:
    """Where a row stands in its file."""
    return F.struct("block", "line")

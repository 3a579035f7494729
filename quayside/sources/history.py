"""History files that are checked once: a manifest remembers which can be read to their last row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources import files

MANIFEST = "path string, length bigint, modified timestamp, rows bigint, reason string"
# A file without rows is at least a footer; one larger than this that shows no row has none that can be read.
EMPTY_BYTES = 1 << 20


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modified, name) of the files below a folder, or of given ones; contents are not read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("name"))


def check_files(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame:
    """MANIFEST rows of parquet files: `reason` tells why one cannot be read to its last row, null if it can.

    Spark counts the rows that the footers state and those that it can decode, all columns of `schema`
    (by default of any file), page checksums verified. Both go by ranges of a file, so large files are checked by many tasks
    and none is held whole. Only small files without any row are opened once more, to tell empty from unreadable ones.
    """
    if not paths:
        return spark.createDataFrame([], MANIFEST)
    reader = spark.read.option("ignoreCorruptFiles", True).option("parquet.page.verify-checksum.enabled", True)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    try:
        found = reader.parquet(*paths)
    except Exception as fault:  # no file has a footer to take a schema from
        if "UNABLE_TO_INFER_SCHEMA" not in str(fault):
            raise
        found = spark.createDataFrame([], "none int")
    listed = listed_files(spark, paths)
    out = listed
    if found.columns != ["none"]:
        name = F.col("_metadata.file_path").alias("name")
        stated = found.select(name).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
        # A hash of all columns makes the reader decode them.
        decoded = found.select(name, F.xxhash64(*found.columns).alias("h")).groupBy("name").agg(
            F.count(F.lit(1)).alias("decoded"), F.bit_xor("h").alias("h")
        )
        out = out.join(stated, "name", "left").join(decoded.select("name", "decoded", "h"), "name", "left")
    else:
        none = F.lit(None).cast("bigint")
        out = out.withColumns({"rows": none, "decoded": none, "h": none})
    # The limit reaches the listing, so that larger files are not opened.
    small = spark.read.format("binaryFile").load(paths).filter(F.col("length") <= EMPTY_BYTES)
    small = small.join(out.filter("rows IS NULL").select("path"), "path", "left_semi")
    empty = small.select("path", "content").mapInArrow(_empty_files, "path string, reason string")
    out = out.join(empty.withColumnRenamed("reason", "fault"), "path", "left")
    partly = F.concat(F.coalesce("decoded", F.lit(0)).cast("string"), F.lit(" of "), F.col("rows").cast("string"), F.lit(" rows can be read"))
    # The hash is asked for, else Spark would not decode the columns for it.
    whole = (F.col("rows") == F.coalesce("decoded", F.lit(0))) & ((F.col("rows") == 0) | F.col("h").isNotNull())
    reason = (
        F.when(whole, F.lit(None))
        .when(F.col("rows").isNotNull(), partly)
        .when(F.col("fault") == "", F.lit(None))
        .otherwise(F.coalesce("fault", F.lit("no row can be read")))
    )
    return out.select("path", "length", "modified", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), reason.alias("reason"))


def _empty_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small files from which no row came: an empty reason if the footer is sound and states none."""
    for batch in batches:
        for name, content in zip(*batch.columns, strict=True):
            try:
                rows = pq.ParquetFile(pa.BufferReader(content.as_py())).metadata.num_rows
                reason = "" if rows == 0 else f"0 of {rows} rows can be read"
            except (pa.ArrowException, OSError, ValueError) as fault:
                reason = f"{type(fault).__name__}: {fault}"[:500]
            yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([reason])], ["path", "reason"])


def checked_files(spark: SparkSession, path: str, manifest: str, schema: str | None = None) -> DataFrame:
    """MANIFEST rows of the files that a history folder holds now, from the manifest kept under `manifest`.

    Only files that it does not have yet, by path, size and time of change, are checked and added.
    """
    known = spark.read.schema(MANIFEST).parquet(manifest) if files.exists(spark, manifest) else spark.createDataFrame([], MANIFEST)
    keys = ["path", "length", "modified"]
    listed = listed_files(spark, path).select(*keys)
    # Names of the files that came since the last run, as a file index would hold them.
    new = [r.path for r in listed.join(known, keys, "left_anti").select("path").collect()]
    if new:
        check_files(spark, new, schema).write.mode("append").parquet(manifest)
        known = spark.read.schema(MANIFEST).parquet(manifest)
    return known.dropDuplicates(keys).join(listed, keys, "left_semi")


def read_files(spark: SparkSession, path: str, names: list[str], schema: str) -> DataFrame:
    """Rows of given files below `path`, with the columns of its folders."""
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*names)


def read_checked_history(
    spark: SparkSession, path: str, manifest: str, schema: str, skip_unreadable: bool = False
) -> DataFrame:
    """Rows of the history files that the manifest finds sound; any other file is an error, or with `skip_unreadable` left out whole."""
    verdicts = checked_files(spark, path, manifest, schema)
    bad = verdicts.filter("reason IS NOT NULL")
    if not skip_unreadable:
        first = bad.first()
        if first:
            raise ValueError(f"{first.path}: {first.reason}")
        return spark.read.schema(schema).parquet(path)
    if bad.isEmpty():
        return spark.read.schema(schema).parquet(path)
    sound = [r.path for r in verdicts.filter("reason IS NULL AND rows > 0").select("path").collect()]
    return read_files(spark, path, sound, schema)

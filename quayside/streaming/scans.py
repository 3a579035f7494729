"""Drain scan inboxes, each file exactly once, into a history table or through a chain of writes."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import blank_to_null, fold_code
from quayside.operators.projections import stamp
from quayside.sources import files


def drain_scans(
    spark: SparkSession,
    inbox: str,
    history: str,
    checkpoint: str,
    schema: str,
    code: str,
    max_files: int = 10_000,
    **stamps: Any,
) -> None:
    """Append every new file of `inbox` to `history` and stop.

    Codes are upper-cased, blank codes dropped, and rows stamped with the given
    constants. The checkpoint remembers consumed files and the parquet sink commits
    whole batches, so a run after a crash neither loses nor repeats a scan.
    """
    scans = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(inbox)
    )
    cleaned = scans.withColumn(code, blank_to_null(fold_code(code))).dropna(subset=[code])
    query = (
        stamp(cleaned, **stamps)
        .writeStream.format("parquet")
        .option("path", history)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
    query.awaitTermination()


@dataclass(frozen=True)
class Inbox:
    """A folder of delimited scan files with a header; `code` names the scanned column."""

    path: str
    schema: str
    code: str


def new_scans(spark: SparkSession, inboxes: Mapping[str, Inbox], max_files: int = 10_000) -> DataFrame:
    """One stream of the scans of several inboxes, told apart by `inbox`; codes are folded and blank ones dropped."""
    streams = []
    for name, box in inboxes.items():
        read = spark.readStream.schema(box.schema).option("header", True).option("maxFilesPerTrigger", max_files)
        scans = read.csv(box.path).withColumn(box.code, blank_to_null(fold_code(box.code))).dropna(subset=[box.code])
        streams.append(scans.withColumn("inbox", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def drain_chain(
    spark: SparkSession,
    inboxes: Mapping[str, Inbox],
    raw: str,
    checkpoint: str,
    as_of: date,
    follow: Callable[[SparkSession, DataFrame, date], None],
    max_files: int = 10_000,
) -> None:
    """Keep every new scan of the inboxes under `raw`, then let `follow` rewrite what a day's scans lead to; stop.

    All inboxes are one query, so what arrives together is one batch. Its scans are kept in a folder of
    the batch's number, with the day of the run that first kept them. A crash at any later point
    repeats the batch under the same number: the kept folder then stands as it is, with its day, also if the repeat
    runs on another day. `follow` gets all kept scans of the batch's day and must replace, not append; so
    it may run any number of times. Together each scan counts once in everything that follows.
    """

    def handle(batch: DataFrame, number: int) -> None:
        session, folder = batch.sparkSession, f"{raw.rstrip('/')}/run={number}"
        if not files.exists(session, f"{folder}/_SUCCESS"):
            batch.withColumn("as_of", F.lit(as_of)).write.mode("overwrite").parquet(folder)
        kept = session.read.parquet(folder)
        first = kept.select("as_of").first()
        if first:  # else no scan had a code
            every = session.read.schema(kept.schema).parquet(raw)
            follow(session, every.filter(F.col("as_of") == F.lit(first.as_of)).drop("run"), first.as_of)

    query = (
        new_scans(spark, inboxes, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def of_inbox(scans: DataFrame, name: str) -> DataFrame:
    return scans.filter(F.col("inbox") == name).drop("inbox")

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators.joins import skew_join
from quayside.session import remove_path, scratch_path
from quayside.sources.sinks import materialize

# ASCII letters are lower-cased; every other ASCII byte but digits parts words. Bytes of
# other characters belong to words.
FOLD = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters of a UTF-8 text, A-Z lower-cased."""
    return text.translate(FOLD).split() if text else []


_held: dict[str, object] = {}


def sole(key: str, make: Callable[[], object]):
    """The worker's object under `key`, made once. Python workers outlive a task, so it serves later
    ones too; an object of another key is dropped, so that a worker holds one at a time.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column as UTF-8 bytes, one at a time and without decoding."""
    return (value.as_py() for value in column.cast(pa.binary()))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which may not have it installed; once per context."""
    context = spark.sparkContext
    if getattr(context, "_quayside_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="quayside-")) / "quayside.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context._quayside_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written intermediate tables of one job in the shared folder; `drop` removes them early."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.paths = spark, scratch_path(spark, label), 0

    def path(self) -> str:
        self.paths += 1
        return f"{self.root}/{self.paths:03d}"

    def keep(self, df: DataFrame) -> DataFrame:
        """Write `df` and read it back: later steps neither recompute it nor depend on executors."""
        return self.at(df, self.path())

    def at(self, df: DataFrame, path: str) -> DataFrame:
        kept = materialize(df, path)
        kept.scratch_path = path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        for df in kept:
            remove_path(self.spark, df.scratch_path)


def per_batch(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """Apply a function of Arrow batches to each batch of `df`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (shift, multiply, shift)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected `edges` (a, b) that is not the smallest
    node of its component, which is the component's name.

    Alternating star contraction: each round links a node's larger neighbours, then its smaller
    ones, to the smallest node around it. Rounds grow with the logarithm of the longest path.
    Every round is written, so nothing is recomputed and a lost executor costs its tasks only.
    Nulls and loops in `edges` are ignored.
    """
    current = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    mark = _fingerprint(current)
    while True:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # The edges of a star's centre are a hot key.
        large = skew_join(both.where("v > u"), smallest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = scratch.keep(large.distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = skew_join(large, least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        following = scratch.keep(small.union(least.select("hi", F.col("m").alias("lo"))).distinct())
        scratch.drop(current, large)
        current, before = following, mark
        mark = _fingerprint(current)
        if mark == before:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def numbered(scratch: Scratch, rows: DataFrame, group: str, order: list[str], name: str = "place", total: str = "total") -> DataFrame:
    """`rows`, written, with each row's place (from 0) in its group's order and the group's number of rows.

    Rows are dealt by ranges of (group, order), so that one group may spread over many tasks. Each range
    counts its rows per group; running sums over the ranges give the places. Rows equal in `order` follow in the
    order they were written in, which also parts them, so that no range grows with the copies of a row.
    Missing values come first. `rows` should be a written table, as dealing by ranges reads it twice.
    """
    at = scratch.keep(rows.withColumn("_at", F.monotonically_increasing_id()))
    ranges = at.repartitionByRange(group, *order, "_at").sortWithinPartitions(group, *order, "_at")
    # The lower 33 bits number the rows of a task; the upper ones are the task.
    held = scratch.keep(ranges.drop("_at").withColumn("_seq", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_seq", 33)))
    per = held.groupBy("_part", group).agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # A group has one row per range here.
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        F.col("_part").alias("_p"),
        F.col(group).alias("_g"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias(total),
    )
    placed = held.join(per, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    scratch.drop(at)
    return placed.withColumn(name, F.col("_seq") + F.col("_shift")).drop("_part", "_p", "_g", "_shift", "_seq")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.xxhash64("lo", "hi") % 1_000_003)
        ).first()
    )

"""State kept by key: an update rewrites only the buckets that it touches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.dedupe import keep_last
from quayside.operators.setops import stack
from quayside.session import scratch_path
from quayside.sources import files
from quayside.sources.sinks import append_state, materialize

BUCKET = "bucket"
PENDING = "_pending"


@dataclass(frozen=True)
class KeyedState:
    """Rows of `schema` under `path`, dealt into `buckets` folders by a hash of the column `key`.

    An update writes the new content of the touched buckets beside the state, notes that in a small
    file, and only then replaces the folders. A run that finds such a note finishes the replacement
    first, so a crash at any point leaves the state before the update or after it.
    """

    spark: SparkSession
    path: str
    schema: str
    key: str
    buckets: int = 256

    def bucket(self, key: Column | None = None) -> Column:
        """A missing key has a bucket as well."""
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        """All rows; empty before the first update."""
        return self._rows().drop(BUCKET)

    def read_for(self, keys: DataFrame) -> DataFrame:
        """Rows in the buckets of `keys` (a frame with the key column); other folders are not listed."""
        return self._rows(self._touched(keys)).drop(BUCKET)

    def upsert(self, new: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the touched buckets by `merge` of their old and new rows; returns their numbers.

        `merge` sees whole buckets and must treat each key alone, so that rows of other keys stay as they are. Applied
        again with the same rows it should change nothing; then a rerun does not either.
        """
        new = new.select(*self._columns())
        touched = self._touched(new)
        if touched:
            self._replace(touched, merge(stack([self._rows(touched).drop(BUCKET), new])))
        return touched

    def replace(self, keys: DataFrame, rows: DataFrame) -> list[int]:
        """Put `rows` in place of all rows whose key is among `keys`, a missing one included if `keys` has it; returns the buckets."""
        wanted = keys.select(self.key).distinct()
        touched = self._touched(wanted)
        if touched:
            old = self._rows(touched).drop(BUCKET)
            known = wanted.withColumn("_gone", F.lit(True)).withColumnRenamed(self.key, "_key")
            kept = old.join(known, old[self.key].eqNullSafe(known["_key"]), "left").filter(F.col("_gone").isNull()).drop("_gone", "_key")
            self._replace(touched, stack([kept, rows.select(*self._columns())]))
        return touched

    def _columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def _rows(self, only: list[int] | None = None) -> DataFrame:
        self._recover()
        present = {name for name in files.children(self.spark, self.path) if name.startswith(f"{BUCKET}=")}
        if only is not None:
            present &= {f"{BUCKET}={b}" for b in only}
        if not present:
            return self.spark.createDataFrame([], f"{self.schema}, {BUCKET} int")
        rows = self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(self.path)
        return rows if only is None else rows.filter(F.col(BUCKET).isin(*only))

    def _touched(self, rows: DataFrame) -> list[int]:
        # At most `buckets` numbers reach the driver.
        return sorted(r[0] for r in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    def _replace(self, touched: list[int], rows: DataFrame) -> None:
        staged = scratch_path(self.spark, "keyed")
        materialize(rows.select(*self._columns(), self.bucket().alias(BUCKET)), staged)
        files.write_text(self.spark, f"{self.path}/{PENDING}", "\n".join([staged, *map(str, touched)]))
        self._recover()

    def _recover(self) -> None:
        note = f"{self.path}/{PENDING}"
        if not files.exists(self.spark, note):
            return
        staged, *touched = files.read_text(self.spark, note).split("\n")
        rows = self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(staged)
        held = {r[0] for r in rows.select(BUCKET).distinct().collect()}
        if held:
            append_state(rows, self.path, BUCKET)
        for bucket in set(map(int, touched)) - held:  # nothing is left in these
            files.delete(self.spark, f"{self.path}/{BUCKET}={bucket}")
        files.delete(self.spark, note)
        files.delete(self.spark, staged)


def last_of_each(keys: list[str], order: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A merge that keeps the last row of each key."""
    return lambda rows: keep_last(rows, keys, order)

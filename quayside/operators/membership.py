"""Which rows are new: a small filter on the large side, exact comparison of what passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def _places(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(hashes)]


def bloom_words(rows: DataFrame, key: Column, bits: int = 1 << 23, hashes: int = 3) -> Column:
    """A Bloom filter of the rows' keys as one array of 64-bit words, a subquery to be used in a condition.

    Its size is `bits`, however many rows there are: more rows let more pass that need not. Each task sends the
    words it has set at most once.
    """
    at = rows.select(F.explode(F.array(*_places(key, bits, hashes))).alias("at"))
    words = at.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("set")
    )
    every = rows.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    filled = every.join(words, "word", "left").select("word", F.coalesce("set", F.lit(0)).cast("bigint").alias("set"))
    listed = filled.agg(F.array_sort(F.collect_list(F.struct("word", "set"))).alias("w"))
    return listed.select(F.transform("w", lambda w: w["set"]).alias("w")).scalar()


def may_hold(words: Column, key: Column, bits: int = 1 << 23, hashes: int = 3) -> Column:
    """Whether a key may be in the filter; never false for one that is."""
    found = []
    for at in _places(key, bits, hashes):
        word = F.element_at(words, F.floor(at / 64).cast("int") + 1)
        # An arithmetic shift, so the last bit is what counts.
        found.append(F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return reduce(lambda a, b: a & b, found)


def equal_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def new_rows(history: DataFrame, rows: DataFrame, bits: int = 1 << 23) -> DataFrame:
    """Distinct `rows` that `history` does not hold; missing values are equal to each other.

    A Bloom filter of the rows goes to the scan of the history, so only what it may have in common with them is
    shuffled and compared, exactly. The whole history is neither shuffled nor made distinct again.
    """
    columns = rows.columns
    fresh = rows.distinct()
    alike = history.select(*columns).filter(may_hold(bloom_words(fresh, row_key(columns), bits), row_key(columns), bits))
    return fresh.join(alike, equal_rows(fresh, alike, columns), "left_anti")


def consolidated(history: DataFrame, rows: DataFrame, required: str, bits: int = 1 << 23) -> DataFrame:
    """As `setops.consolidate` of both, where `history` holds distinct rows with a `required` value already."""
    kept = rows.dropna(subset=[required]).select(*history.columns)
    return history.unionByName(new_rows(history, kept, bits))

"""Join helpers for outer joins and for keys of very uneven size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Equi join; several matches fan out. Missing keys match each other only with `null_safe`."""
    if not null_safe:
        return left.join(right, on, "left")
    keys = [on] if isinstance(on, str) else list(on)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, same), "left").drop(*[f"_r_{k}" for k in keys])


def right_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Every row of `right` with all its matches in `left`, of which one key may hold most."""
    return fan_out_join(right, left, on)


def outer_join_filled(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, key: str
) -> DataFrame:
    """Full outer join on differently named keys, with one filled key column."""
    # Fit for sides that are aggregated by their key; `full_join_few` takes an uneven left side.
    a = left.withColumnRenamed(left_key, "_lk")
    b = right.withColumnRenamed(right_key, "_rk")
    joined = a.join(b, F.col("_lk") == F.col("_rk"), "full")
    return joined.withColumn(key, F.coalesce("_rk", "_lk")).drop("_lk", "_rk")


def full_join_few(many: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Full outer join of `many` rows per key, of which one key may hold most, with at most one
    row per key in `few`.

    Spark never splits a full join. A left join finds the partners of `many`, and a left
    anti join the rows of `few` without one, against the distinct keys of `many`.
    """
    matched = skew_join(many, few, key, "left")
    known = many.select(key).distinct()
    return matched.unionByName(few.join(known, key, "left_anti"), allowMissingColumns=True)


def skew_join(
    facts: DataFrame, dims: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Join many `facts` per key, or without a key, with few `dims` per key.

    Adaptive execution cuts an oversized partition of the facts into several tasks, and
    hands each the matching dims, but only where both inputs come straight from a
    shuffle. Dims that are already partitioned by the key, being aggregated by it, would
    not. Joining on the key and its hash asks for a partitioning that neither side has
    yet: the small side is shuffled once more, and a hot key can be split at run time.
    Only the facts may be split, hence inner, left and left semi joins.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"skew_join supports inner, left and left_semi, not {how}")
    cell = F.hash(key)
    joined = facts.withColumn("_cell", cell).join(
        dims.withColumn("_cell", cell), [key, "_cell"], how
    )
    return joined.drop("_cell")


def fan_out_join(
    dims: DataFrame,
    facts: DataFrame,
    key: str,
    present: str | None = None,
) -> DataFrame:
    """Left join of `dims` with many `facts` per key, of which one key may hold most.

    A left join may only be split on its left side, yet here the right side is the
    uneven one. One stub fact per key of `dims` turns it into an inner join, of which
    both sides may be split; the stub of a key that has facts is dropped afterwards.
    Missing keys match nothing and keep their row.

    `present` names a column of `dims` that is set where the key has facts; without it
    one is made.
    """
    if present is None:
        present = "_present"
        known = facts.filter(F.col(key).isNotNull()).select(key).distinct()
        dims = skew_join(dims, known.withColumn(present, F.lit(True)), key, "left")
    stubs = dims.select(key).distinct().withColumn("_stub", F.lit(True))
    many = facts.filter(F.col(key).isNotNull()).unionByName(stubs, allowMissingColumns=True)
    many = many.withColumnRenamed(key, "_fact_key")
    joined = many.join(dims, F.col("_fact_key").eqNullSafe(F.col(key)), "inner")
    kept = joined.filter(F.col("_stub").isNull() | F.col(present).isNull())
    return kept.drop("_stub", "_fact_key", "_present")


def outer_chain(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of many frames on one key; several matches fan out.

    Spark can neither split a skewed full outer join nor keep its partitioning. So each
    frame is first padded with an empty row for every key that only others have; then
    inner joins do, which share one partitioning and which a hot key may split (with
    `spark.sql.adaptive.forceOptimizeSkewedJoin`, as it costs a shuffle in a chain).
    Rows without a key are dropped.
    """
    frames = [frame.filter(F.col(key).isNotNull()) for frame in frames]
    marked = [frame.select(key, F.lit(1 << i).alias("_in")) for i, frame in enumerate(frames)]
    # One mask for all frames, so that every use of it shares one shuffle.
    masks = reduce(DataFrame.unionByName, marked).groupBy(key).agg(F.bit_or("_in").alias("_in"))
    padded = []
    for i, frame in enumerate(frames):
        absent = masks.filter(F.col("_in").bitwiseAND(F.lit(1 << i)) == 0).select(key)
        padded.append(frame.unionByName(absent, allowMissingColumns=True))
    return reduce(lambda a, b: a.join(b, key), padded)

"""Order-dependent row operators.

Input order is never implied: every operator takes an order, and the order must
be total within a key for the outcome to be defined.

Sizes of the groups do not matter to `keep_first` and `keep_last`: Spark turns a
`row_number() = 1` filter into a group limit that runs before the shuffle, so a
key that holds a third of all rows sends one row per map task. Operators that
must see every row of a key after the shuffle (flagging repeats) avoid windows
and use a map-side combined minimum instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.text import as_col

_RN = "_rn"


def nulls_last(c: Column | str) -> Column:
    """An ascending sort value in which missing values come last."""
    col = as_col(c)
    return F.struct(col.isNull().alias("n"), col.alias("v"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ascending order; missing keys form one group."""
    w = Window.partitionBy(*keys).orderBy(*[as_col(c).asc_nulls_first() for c in order])
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the last in ascending order; missing keys form one group."""
    w = Window.partitionBy(*keys).orderBy(*[as_col(c).desc_nulls_last() for c in order])
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def flag_repeats(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], flag: str = "is_repeat"
) -> DataFrame:
    """Flag all but the first row of each key.

    The first order value of each key is found with a combined minimum and joined
    back on key and order value. That pair is unique per row, so the join spreads
    evenly however large one key is.
    """
    position = F.struct(*[as_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    numbered = df.withColumn("_pos", position)
    heads = numbered.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min("_pos").alias("_head")
    )
    heads = heads.withColumn("_is_head", F.lit(True))
    same_row = [F.col("_pos") == F.col("_head")]
    same_row += [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = numbered.join(heads, reduce(lambda a, b: a & b, same_row), "left")
    return joined.withColumn(flag, F.col("_is_head").isNull()).select(*df.columns, flag)


def flag_repeats_bounded(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], flag: str = "is_repeat"
) -> DataFrame:
    """As `flag_repeats`, by window: for groups with a known small bound only."""
    w = Window.partitionBy(*keys).orderBy(*[as_col(c).asc_nulls_first() for c in order])
    return df.withColumn(flag, F.row_number().over(w) > 1)


def attribute_to_first(
    df: DataFrame,
    key: str,
    order: Sequence[Column | str],
    blanked: Column,
    measures: Sequence[str],
    drop_repeat_when: Column,
) -> DataFrame:
    """Keep per-key measures on the first row of the key only.

    Blanked rows take no part and pass through. Of the others, repeats lose the
    measures and are dropped where `drop_repeat_when` holds.
    """
    marked = df.withColumn("_blanked", F.coalesce(blanked, F.lit(False)))
    flagged = flag_repeats(marked, [key, "_blanked"], order, "_repeat").withColumn(
        "_repeat", F.col("_repeat") & ~F.col("_blanked")
    )
    kept = flagged.filter(~F.col("_repeat") | ~F.coalesce(drop_repeat_when, F.lit(False)))
    single = {m: F.when(~F.col("_repeat"), F.col(m)) for m in measures}
    return kept.withColumns(single).drop("_repeat", "_blanked")


def reduce_partial_deliveries(
    df: DataFrame,
    id_col: str,
    po: str,
    qced: str,
    order: Sequence[Column | str],
    flag: str = "is_repeat",
) -> DataFrame:
    """At most two rows per PO: its first counted and its first uncounted row.

    Three dependent steps, all under the order (count date, missing last; `order`):
    one row per (id, count date); repeats of a PO flagged; one row per (PO, counted
    or not). Rows without a PO are one PO.

    In that order counted rows come before uncounted ones, so after the last step a
    row is a repeat exactly when it is uncounted and its PO has a counted row too.
    The flag therefore needs no window over all rows of a PO, only the two survivors.
    """
    full_order = [nulls_last(qced), *order]
    unique = df if id_col == po else keep_first(df, [id_col, qced], full_order)
    counted = unique.withColumn("_counted", F.col(qced).isNotNull())
    survivors = keep_first(counted, [po, "_counted"], full_order)
    pair = Window.partitionBy(po)
    return survivors.withColumn(
        flag, ~F.col("_counted") & F.max("_counted").over(pair)
    ).drop("_counted")

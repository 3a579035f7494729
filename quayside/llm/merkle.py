"""A Merkle manifest of a table: a tree of hashes per source, a tree of sources, proofs per row."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, numbered

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values in a form that parts them: `-` for null, else the UTF-8 byte count, `:` and the value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(
    rows: DataFrame, scratch: Scratch, source: str = "source", order: str = "doc_id", leaf: str = "leaf", fanout: int = FANOUT
) -> DataFrame:
    """Each row of `rows` with its `subroot`, the `root` and its `path` to the root.

    Rows of a source are ordered by `order` (null first); rows equal in it by their leaf, and repeated rows are
    leaves of their own. Every `fanout` consecutive nodes of a source become one, the last run perhaps from
    fewer, until one is left, its subroot. Subroots in order of the source (null first, by UTF-8 bytes) become the root in
    the same way. `path` lists, level by level from the leaf, the siblings `left` and `right` of the row's node,
    their digests joined; a level is left out where a source or the sources have one node.

    A level is one conditional aggregate per slot, which spreads the children of a parent over `fanout` columns. The
    columns joined are hashed to the parent; without the own one they are the siblings. Children of a parent are at most
    `fanout` rows, so a source may hold any share of the rows. Paths are made from the root down, a row per parent, and meet the
    leaves in the last step only. An empty table gives no rows; columns of the names added are replaced.
    """
    extra = [c for c in rows.columns if c not in (leaf, "subroot", "root", "path")]
    # One key that is never null and sorts like the source, null first.
    keyed = rows.select(
        F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit("0")).alias("_grp"),
        F.col(order).alias("_order"),
        F.col(leaf).alias("_digest"),
        F.struct(*extra).alias("_row"),
    )
    leaves = scratch.keep(numbered(scratch, keyed, "_grp", ["_order", "_digest"], "_pos", "_total"))
    tops, runs = _climb(leaves.select("_grp", "_pos", "_total", "_digest", "_row"), scratch, fanout, "_row")
    # The same again over the subroots, as the nodes of one group.
    heads = tops.select(F.lit("").alias("_grp"), F.col("_grp").alias("_order"), "_digest")
    heads = scratch.keep(numbered(scratch, heads, "_grp", ["_order"], "_pos", "_total"))
    root, above = _climb(heads.select("_grp", "_pos", "_total", "_digest", "_order"), scratch, fanout, "_order")
    none = F.array().cast("array<struct<left:string,right:string>>")
    root = root.select("_grp", F.lit(0).alias("_pos"), F.col("_digest").alias("_root"), none.alias("_path"), "_height")
    subroots = _descend(root, above, heads, scratch, "_order", ["_root"])
    subroots = subroots.select(F.col("_order").alias("_grp"), F.lit(0).alias("_pos"), F.col("_digest").alias("_subroot"), "_root", "_path")
    subroots = subroots.join(tops.select("_grp", "_height"), "_grp")
    found = _descend(scratch.keep(subroots), runs, leaves, scratch, "_row", ["_subroot", "_root"])
    named = [F.col(f"_row.`{c}`").alias(c) for c in extra]
    return found.select(
        *named, F.col("_digest").alias(leaf), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_path").alias("path")
    )


def _slots(fanout: int) -> list[str]:
    return [f"_c{k}" for k in range(fanout)]


def _climb(nodes: DataFrame, scratch: Scratch, fanout: int, held: str) -> tuple[DataFrame, list[DataFrame]]:
    """Top node and height of every group, and per level the runs of children that became one node.

    A run is (group, place of its parent, one column per slot, digest). Slots of the first level hold (digest, `held`).
    """
    runs: list[DataFrame] = []
    tops = [nodes.where("_total = 1").select("_grp", "_digest", F.lit(0).alias("_height"))]
    level = nodes.where("_total > 1")
    most = nodes.agg(F.max("_total").alias("n")).first().n or 0
    while most > 1:
        first = not runs
        child = F.struct("_digest", held) if first else F.struct("_digest")
        slot, parent = F.col("_pos") % fanout, F.floor(F.col("_pos") / fanout)
        spread = [F.first(F.when(slot == k, child), ignorenulls=True).alias(c) for k, c in enumerate(_slots(fanout))]
        wide = level.groupBy("_grp", "_total", parent.cast("bigint").alias("_pos")).agg(*spread)
        digest = F.sha2(F.concat_ws("", *[F.col(f"{c}._digest") for c in _slots(fanout)]), 256)
        wide = wide.withColumn("_total", F.ceil(F.col("_total") / fanout).cast("bigint")).withColumn("_digest", digest)
        runs.append(scratch.keep(wide))
        tops.append(runs[-1].where("_total = 1").select("_grp", "_digest", F.lit(len(runs)).alias("_height")))
        level = runs[-1].where("_total > 1").select("_grp", "_pos", "_total", "_digest")
        most = -(-most // fanout)
    return functools.reduce(DataFrame.unionByName, tops), runs


def _descend(tops: DataFrame, runs: list[DataFrame], nodes: DataFrame, scratch: Scratch, held: str, carried: Sequence[str]) -> DataFrame:
    """`held`, digest, `carried` and path of every node of the lowest level, from the paths of the groups' top nodes."""
    at = ["_grp", "_pos"]
    down = None
    for height in range(len(runs), 0, -1):
        known = tops.where(F.col("_height") == height).select(*at, *carried, "_path")
        down = known if down is None else known.unionByName(down)
        slots = _slots(len([c for c in runs[height - 1].columns if c.startswith("_c")]))
        digests = [F.col(f"{c}._digest") for c in slots]
        children = [
            F.struct(
                F.lit(k).alias("slot"),
                F.col(c).alias("child"),
                F.struct(F.concat_ws("", *digests[:k]).alias("left"), F.concat_ws("", *digests[k + 1 :]).alias("right")).alias("step"),
            )
            for k, c in enumerate(slots)
        ]
        each = runs[height - 1].drop("_digest").join(down, at)
        each = each.select(*at, *carried, "_path", F.explode(F.filter(F.array(*children), lambda s: s["child"].isNotNull())).alias("s"))
        down = each.select(
            "_grp",
            (F.col("_pos") * len(slots) + F.col("s.slot")).alias("_pos"),
            *carried,
            F.concat(F.array("s.step"), "_path").alias("_path"),
            *([F.col("s.child._digest").alias("_digest"), F.col(f"s.child.{held}").alias(held)] if height == 1 else []),
        )
        if height > 1:
            down = scratch.keep(down)
    single = nodes.where("_total = 1").join(tops.where("_height = 0").select("_grp", *carried, "_path"), "_grp")
    single = single.select(held, "_digest", *carried, "_path")
    return single if down is None else single.unionByName(down.select(held, "_digest", *carried, "_path"))

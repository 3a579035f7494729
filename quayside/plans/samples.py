"""Audit trail of samples: the plan against six scan stages."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import config_code, fold_code
from quayside.operators.aggregates import group_agg, present_counts
from quayside.operators.dedupe import keep_last
from quayside.operators.joins import left_join, outer_chain
from quayside.operators.predicates import month_window
from quayside.operators.setops import stack
from quayside.operators.sorting import sort_keys
from quayside.sources.schemas import SAMPLE_STAGES

PLAN_COLUMNS = (
    "gl_day",
    "gl_month",
    "gl_year",
    "config_sku",
    "config_name",
    "supplier",
    "designer",
    "category",
    "buyer",
)


def sample_plan(
    plan: DataFrame, checks: DataFrame, as_of: date, months: int = 2
) -> DataFrame:
    """Last planned row per config around `as_of`, with the item's last quality check.

    `checks` has (simple_sku, qc_date, qc_count). Its last row per item is taken before
    the join: of the joined rows of an item, only that one can be the config's last.
    """
    last = keep_last(plan, ["simple_sku", "gl_month"], ["seq"])
    last = last.filter(F.col("total_cost") > 0)
    configs = keep_last(last, ["config_sku"], ["seq"])
    checked = checks.groupBy("simple_sku").agg(
        F.max(F.struct("qc_date", "qc_count")).alias("_last")
    )
    rows = left_join(configs, checked, "simple_sku").select(
        *PLAN_COLUMNS,
        F.col("_last.qc_date").alias("qc_date"),
        F.col("_last.qc_count").alias("qc_count"),
    )
    return month_window(rows, "gl_year", "gl_month", as_of, months, months)


def reduced_history(history: DataFrame, order: str = "seq") -> DataFrame:
    """Last row per item and first-stage time; missing times form one group."""
    return keep_last(history, ["sku", SAMPLE_STAGES[0]], [order])


def stage_tables(
    history: DataFrame, scans: Mapping[str, DataFrame], shift: date
) -> list[DataFrame]:
    """Per stage: known (item, time) pairs of the reduced history, plus new scans stamped now."""
    tables = []
    history = reduced_history(history)
    for stage in SAMPLE_STAGES:
        frames = [history.select("sku", stage).dropna().distinct()]
        if stage in scans:
            new = scans[stage].select(fold_code("sku").alias("sku"), F.lit(shift).alias(stage))
            frames.append(new)
        tables.append(stack(frames))
    return tables


def stage_chain(tables: list[DataFrame], latest_per_stage: bool = False) -> DataFrame:
    """All stages of an item side by side.

    An item scanned several times in several stages gives every combination. With
    `latest_per_stage`, only the last scan per stage is kept first.
    """
    if latest_per_stage:
        tables = [
            t.groupBy("sku").agg(F.max(s).alias(s)) for t, s in zip(tables, SAMPLE_STAGES)
        ]
    return outer_chain(tables, "sku")


def stage_rows(history: DataFrame, scans: DataFrame, shift: date) -> DataFrame:
    """The reduced history and new scans, given as (sku, number of the stage), as rows of one shape."""
    return stack([reduced_history(history).select("sku", *SAMPLE_STAGES), stamped_stages(scans, shift)])


def latest_stages(rows: DataFrame) -> DataFrame:
    """Per item the last time of every stage, in one aggregate: the chain of the stages' last
    scans without its joins."""
    scanned = rows.dropna(subset=["sku"]).dropna(how="all", subset=list(SAMPLE_STAGES))
    return scanned.groupBy("sku").agg(*[F.max(s).alias(s) for s in SAMPLE_STAGES])


def last_stages(rows: DataFrame) -> DataFrame:
    """The last combination per (config, first stage), without building combinations.

    Of the combinations of an item with one first-stage time, the last holds the latest
    time of every other stage. So one aggregate per item over the other stages, joined
    with the distinct first-stage times, replaces the chain.
    """
    first, others = SAMPLE_STAGES[0], SAMPLE_STAGES[1:]
    last = item_stages(rows).withColumn("config_sku", config_code("sku"))
    return keep_last(last, ["config_sku", first], ["sku", *others]).select(
        "config_sku", "sku", *SAMPLE_STAGES
    )


def item_stages(rows: DataFrame) -> DataFrame:
    """Per (item, first-stage time) the last time of every other stage: what a history has to keep.

    Applied to its own result and further rows, it gives what it gives for all rows at once.
    """
    first, others = SAMPLE_STAGES[0], SAMPLE_STAGES[1:]
    scanned = rows.dropna(subset=["sku"]).dropna(how="all", subset=list(SAMPLE_STAGES))
    latest = scanned.groupBy("sku").agg(*[F.max(s).alias(s) for s in others])
    times = scanned.select("sku", first).dropna().distinct()
    return latest.join(times, "sku", "left").select("sku", *SAMPLE_STAGES)


def stamped_stages(scans: DataFrame, shift: date) -> DataFrame:
    """New scans, given as (sku, number of the stage), as history rows."""
    stamped = [
        F.when(F.col("stage") == i, F.lit(shift)).alias(s)
        for i, s in enumerate(SAMPLE_STAGES, 1)
    ]
    return scans.select(fold_code("sku").alias("sku"), *stamped)


def sample_trail(plan: DataFrame, stages: DataFrame, with_qc_count: bool = False) -> DataFrame:
    """Plan and stages side by side, one row per (config, first stage).

    Stages are unique per (config, first stage) and the plan per config, so the join adds
    no repeats.
    """
    joined = plan.join(stages, "config_sku", "full")
    checks = ["qc_date", "qc_count"] if with_qc_count else ["qc_date"]
    return joined.select(
        "gl_day",
        "gl_month",
        "gl_year",
        "config_sku",
        "sku",
        "config_name",
        "supplier",
        "designer",
        "category",
        "buyer",
        *checks,
        *SAMPLE_STAGES,
    )


def trail_order() -> list[Column]:
    return sort_keys([SAMPLE_STAGES[0], "config_sku"])


def sample_summary(trail: DataFrame) -> DataFrame:
    columns = {c: c for c in ("qc_date", *SAMPLE_STAGES)}
    return group_agg(trail, ["gl_year", "gl_month"], *present_counts(columns))

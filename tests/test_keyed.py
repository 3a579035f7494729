"""Keyed state: only touched buckets change, reruns change nothing, a crash loses nothing."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.sources import files, keyed
from quayside.sources.keyed import KeyedState, last_of_each
from tests.helpers import rows

SCHEMA = "sku string, stage int, n long"


@pytest.fixture
def state(spark, tmp_path):
    return KeyedState(spark, str(tmp_path / "state"), SCHEMA, "sku", buckets=8)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stored(state):
    from pathlib import Path

    return {str(p): p.stat().st_mtime_ns for p in Path(state.path).glob("bucket=*/*.parquet")}


MERGE = last_of_each(["sku", "stage"], ["n"])


def test_two_days_and_a_rerun(spark, state):
    assert rows(state.read()) == []
    first = [(f"P{i}", s, 1) for i in range(20) for s in (1, None)]
    state.upsert(frame(spark, *first), MERGE)
    assert rows(state.read()) == sorted(first, key=str) or len(rows(state.read())) == 40
    before = stored(state)
    day = [("P3", 1, 5), ("P3", 2, 5), (None, 1, 5)]
    touched = state.upsert(frame(spark, *day), MERGE)
    after = stored(state)
    assert len(touched) <= 2
    kept = {p for p in before if int(p.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept and all(after[p] == before[p] for p in kept)  # the files of other buckets are the same
    expected = {(k, s): n for k, s, n in first} | {(k, s): n for k, s, n in day}
    assert {(k, s): n for k, s, n in map(tuple, state.read().collect())} == expected
    state.upsert(frame(spark, *day), MERGE)  # a rerun
    assert {(k, s): n for k, s, n in map(tuple, state.read().collect())} == expected
    assert state.upsert(frame(spark), MERGE) == []


def test_upserts_equal_one_pass_over_everything(spark, state):
    draw, seen = random.Random(4), {}
    for day in range(4):
        data = [(draw.choice([None, *"abcdefghij"]), draw.randint(0, 3), day * 100 + i) for i in range(30)]
        state.upsert(frame(spark, *data), MERGE)
        for k, s, n in data:
            seen[k, s] = max(n, seen.get((k, s), -1))
    assert {(k, s): n for k, s, n in map(tuple, state.read().collect())} == seen


def test_replace_takes_keys_out_and_in(spark, state):
    state.upsert(frame(spark, ("a", 1, 1), ("a", 2, 1), ("b", 1, 1), (None, 1, 1)), MERGE)
    keys = spark.createDataFrame([("a",), (None,), ("new",)], "sku string")
    state.replace(keys, frame(spark, ("a", 9, 9)))
    assert rows(state.read()) == [("a", 9, 9), ("b", 1, 1)]
    state.replace(spark.createDataFrame([("a",), ("b",)], "sku string"), frame(spark))
    assert rows(state.read()) == []


@pytest.mark.parametrize("where", ["before", "during"])
def test_a_crash_leaves_one_side_or_the_other(spark, state, monkeypatch, where):
    state.upsert(frame(spark, ("a", 1, 1), ("b", 1, 1)), MERGE)

    def fail(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        if where == "before":  # the new content is written, the note is not
            broken.setattr(keyed.files, "write_text", fail)
        else:  # the note is there and a folder is already gone
            broken.setattr(keyed, "append_state", lambda df, path, *p: [files.delete(spark, f"{path}/{n}") for n in files.children(spark, path) if n.startswith("bucket")] and fail())
        with pytest.raises(RuntimeError):
            state.upsert(frame(spark, ("a", 1, 7)), MERGE)
    if where == "before":
        assert rows(state.read()) == [("a", 1, 1), ("b", 1, 1)]
    else:
        held = {tuple(r) for r in state.read().collect()}
        assert ("a", 1, 7) in held and ("a", 1, 1) not in held


def test_reading_for_keys_lists_their_buckets_only(spark, state):
    state.upsert(frame(spark, *[(f"P{i}", 1, 1) for i in range(40)]), MERGE)
    found = state.read_for(spark.createDataFrame([("P1",)], "sku string"))
    held = {r[0] for r in found.select(state.bucket()).distinct().collect()}
    assert len(held) == 1 and "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().executedPlan().toString()
    assert found.filter(F.col("sku") == "P1").count() == 1

"""The parallel reader of quoted text against the reader that takes a task per file."""

import random

import pytest

from quayside.sources.quoted import quoted_records, quoted_rows
from tests.helpers import rows

SCHEMA = "a string, b string, c string"


@pytest.fixture
def small_blocks(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def cell(draw):
    content = "".join(draw.choice(['x', 'é', ' ', ',', '\n', '""', "y\n"]) for _ in range(draw.randint(0, 12)))
    if draw.random() < 0.05:
        content = "long\n" * 200  # over several blocks
    return f'"{content}"' if draw.random() < 0.8 or set(content) & set(',\n"') else content or "z"


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_blocks, seed):
    draw = random.Random(seed)
    for name in ("one", "two"):
        lines = [",".join([f"{name}{i}", cell(draw), cell(draw)]) for i in range(150)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + ("\n" if seed else ""))
    expected = spark.read.schema(SCHEMA).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    found = quoted_rows(spark, str(tmp_path), SCHEMA)
    assert rows(found, "a", "b", "c") == rows(expected) and found.count() == 300
    one = quoted_rows(spark, str(tmp_path / "one.csv"), SCHEMA)
    assert spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions() > 20  # one file, many tasks
    ordered = [r.a for r in one.orderBy("block", "line").collect()]
    assert ordered == [f"one{i}" for i in range(150)]


def test_windows_line_ends_and_open_quotes(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_bytes(b'1,"p\r\nq",x\r\n\r\n2,y,z\r\n3,"never closed\r\n4,a,b\r\n')
    found = [r.record for r in quoted_records(spark, str(tmp_path)).orderBy("block", "line").collect()]
    assert found == ['1,"p\nq",x', "", "2,y,z", '3,"never closed\n4,a,b']
    (tmp_path / "a.csv").write_text("")
    assert quoted_rows(spark, str(tmp_path), SCHEMA).count() == 0

"""The manifest of checked history files."""

import pytest
from pyspark.sql import functions as F

from quayside.sources import history
from quayside.sources.history import check_files, checked_files, listed_files, read_checked_history
from quayside.sources.tables import WHOLE, jdbc_options, read_table
from tests.helpers import rows

SCHEMA = "id bigint, text string"


def add(spark, path, n, first=0):
    many = spark.range(first, first + n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    many.coalesce(1).write.mode("append").option("parquet.block.size", 1 << 20).parquet(path)


def damage(tmp_path, name):
    file = max((tmp_path / name).glob("*.parquet"), key=lambda p: p.stat().st_size)
    content = bytearray(file.read_bytes())
    content[len(content) // 2 : len(content) // 2 + 4000] = b"\xff" * 4000
    file.write_bytes(content)
    for crc in (tmp_path / name).glob(".*.crc"):
        crc.unlink()
    return file


@pytest.fixture
def opened(monkeypatch):
    """Which files each check was given."""
    seen, real = [], history.check_files
    monkeypatch.setattr(history, "check_files", lambda spark, paths, schema=None: seen.append(sorted(p.rsplit("/", 1)[1] for p in paths)) or real(spark, paths, schema))
    return seen


def test_only_new_files_are_checked(spark, tmp_path, opened):
    path, manifest = str(tmp_path / "h"), str(tmp_path / "m")
    add(spark, path, 10)
    assert read_checked_history(spark, path, manifest, SCHEMA).count() == 10
    assert read_checked_history(spark, path, manifest, SCHEMA).count() == 10
    assert len(opened) == 1
    before = set(opened[0])
    add(spark, path, 5, 100)
    (tmp_path / "h" / "broken.parquet").write_text("no parquet")
    with pytest.raises(ValueError, match="broken.parquet"):
        read_checked_history(spark, path, manifest, SCHEMA)
    assert len(opened) == 2 and not set(opened[1]) & before and len(opened[1]) == 2
    assert read_checked_history(spark, path, manifest, SCHEMA, skip_unreadable=True).count() == 15
    assert len(opened) == 2
    (tmp_path / "h" / "broken.parquet").unlink()
    assert checked_files(spark, path, manifest, SCHEMA).count() == 2  # what is gone is not listed


def test_verdicts(spark, tmp_path):
    path = str(tmp_path / "h")
    add(spark, path, 200_000)
    spoiled = damage(tmp_path, "h")
    add(spark, path, 3)
    spark.createDataFrame([], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    (tmp_path / "h" / "text.parquet").write_text("x" * 100)
    (tmp_path / "h" / "large.parquet").write_bytes(b"PAR1" + b"x" * (2 << 20))
    paths = [r.path for r in listed_files(spark, path).collect()]
    for schema in (SCHEMA, None):
        found = {r.path.rsplit("/", 1)[1]: r for r in check_files(spark, paths, schema).collect()}
        assert len(found) == len(paths) == 5
        bad = {name for name, r in found.items() if r.reason is not None}
        assert bad == {spoiled.name, "text.parquet", "large.parquet"}
        assert sorted(r.rows for name, r in found.items() if name not in bad) == [0, 3]
    assert check_files(spark, [], SCHEMA).count() == 0


def test_a_large_file_is_checked_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "h")
    add(spark, path, 200_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert spark.read.schema(SCHEMA).parquet(path).rdd.getNumPartitions() > 4
        assert rows(check_files(spark, [r.path for r in listed_files(spark, path).collect()], SCHEMA), "rows", "reason") == [(200_000, None)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_folder_without_sound_files(spark, tmp_path):
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "a.parquet").write_text("x")
    found = read_checked_history(spark, str(tmp_path / "h"), str(tmp_path / "m"), SCHEMA, skip_unreadable=True)
    assert found.count() == 0 and found.columns == ["id", "text"]


def test_a_relational_read_needs_a_split(spark):
    spark.conf.set("spark.quayside.jdbc.url", "jdbc:example:")
    try:
        with pytest.raises(ValueError, match="split"):
            read_table(spark, "items")
        assert "numPartitions" not in jdbc_options(spark, "items", WHOLE)
    finally:
        spark.conf.unset("spark.quayside.jdbc.url")

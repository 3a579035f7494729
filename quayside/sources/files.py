"""Small file operations on whatever store holds a path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _at(spark, path)
    return store.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    store, target = _at(spark, path)
    return sorted(entry.getPath().getName() for entry in store.listStatus(target)) if store.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside and then renamed, so that it is there whole or not at all."""
    store, target = _at(spark, path)
    _, beside = _at(spark, f"{path}._new")
    out = store.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    store.delete(target, False)
    store.rename(beside, target)


def read_text(spark: SparkSession, path: str) -> str:
    store, target = _at(spark, path)
    stream = store.open(target)
    content = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return content


def delete(spark: SparkSession, path: str) -> None:
    store, target = _at(spark, path)
    store.delete(target, True)

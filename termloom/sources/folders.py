"""Folders and small files of the shared file system, by Hadoop's file API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _at(spark, path)
    return files.exists(target)


def drop(spark: SparkSession, path: str) -> None:
    target, files = _at(spark, path)
    files.delete(target, True)


def make(spark: SparkSession, path: str) -> None:
    target, files = _at(spark, path)
    files.mkdirs(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted, without hidden ones; none if it is absent."""
    target, files = _at(spark, path)
    if not files.exists(target):
        return []
    found = [entry.getPath().getName() for entry in files.listStatus(target)]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, in place of what stands there; the parent is made."""
    old, files = _at(spark, source)
    new, _ = _at(spark, target)
    files.mkdirs(new.getParent())
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"Could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, files = _at(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()

"""Batch folders: discovery, and the keys their names carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import between_marks

# Marks in batch folder names, and folder names never read as batches.
STORE_MARKS = ("|kss|", "|kse|")
UUID_MARKS = ("|uuids|", "|uuide|")
SKIPPED_PATHS = ["columnMap", "targetMap", "archive", "persisted", "failed"]


def store_of(path: Column) -> Column:
    return between_marks(path, *STORE_MARKS)


def uuid_of(path: Column) -> Column:
    return between_marks(path, *UUID_MARKS)


def batch_name(uuid: Column, store: Column, name: Column) -> Column:
    """Folder name with both marks; a name that already carries the uuid stays."""
    marked = F.concat(
        F.lit(UUID_MARKS[0]), uuid, F.lit(UUID_MARKS[1]), F.lit(STORE_MARKS[0]), store, F.lit(STORE_MARKS[1]), name
    )
    return F.when(name.contains(uuid), name).otherwise(marked)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` with modification time, found by the file source."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def age_ms(now: Column, then: Column) -> Column:
    return F.unix_millis(now.cast("timestamp")) - F.unix_millis(then.cast("timestamp"))


def discover_batches(files: DataFrame, now: Column, min_age_ms: int) -> DataFrame:
    """Batch folders of a listing (path, modified) whose files are all old enough."""
    usable = files
    for part in SKIPPED_PATHS:
        usable = usable.where(~F.col("path").contains(part))
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    last = usable.groupBy(folder.alias("folder")).agg(F.max("modified").alias("modified"), F.count("*").alias("n_files"))
    aged = last.where(age_ms(now, F.col("modified")) > min_age_ms)
    return aged.select(
        "folder", "n_files", store_of(F.col("folder")).alias("store"), uuid_of(F.col("folder")).alias("batch_uuid")
    )

"""Intermediate tables in the folder the cluster shares.

Statistics that several later stages need are written once and read back. That
cuts the lineage, survives the loss of an executor, and gives Catalyst the real
size of the table, so its own broadcast choice rests on a measured number.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: How many groups Spark gathers into lists by hashing before it sorts what is left.
HASHED_GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else one in the session's warehouse.

    Both are places that the cluster shares; the session's settings stay as they are.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/termloom/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Written:
    """A written table whose size was measured while it was written."""

    table: DataFrame
    rows: int
    width: int


def width_in_bytes(df: DataFrame) -> Column:
    """Approximate bytes of one row: text by length, anything else as 16."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        is_text = isinstance(field.dataType, T.StringType)
        total = total + (F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) if is_text else F.lit(16))
    return total


def publish(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back."""
    path = new_folder(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, label: str) -> Written:
    """``publish`` a table and learn its size from the same write."""
    seen = Observation()
    table = publish(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(width_in_bytes(df)).alias("b")), label)
    size = seen.get
    return Written(table, size["n"], size["b"] or 0)


@contextmanager
def gathering_by_hash(spark: SparkSession, groups: int) -> Iterator[None]:
    """While it holds, lists of up to so many groups in a task are gathered without a sort."""
    before = spark.conf.get(HASHED_GROUPS)
    spark.conf.set(HASHED_GROUPS, groups)
    try:
        yield
    finally:
        spark.conf.set(HASHED_GROUPS, before)

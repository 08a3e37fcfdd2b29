"""Which batches were taken in, and which failed and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import error_code
from termloom.sources.batches import age_ms

LEDGER_SCHEMA = "batch_id string, status string, error string, error_code string, ts timestamp"


def create_ledger(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


# In the order in which a batch may pass through them at one time.
STATUSES = ["arrived", "late", "failed", "persisted", "promoted"]


def record(spark: SparkSession, path: str, batch_id: str, status: str, error: str, now: Column) -> None:
    record_all(spark, path, [(batch_id, status, error)], now)


def record_all(spark: SparkSession, path: str, entries: list[tuple[str, str, str]], now: Column) -> dict[str, str]:
    """Write entries (batch, status, error) as one file; returns the error codes by batch."""
    if not entries:
        return {}
    coded = with_code(spark.createDataFrame(entries, "batch_id string, status string, error string"))
    coded.coalesce(1).withColumn("ts", now.cast("timestamp")).select(
        "batch_id", "status", "error", "error_code", "ts"
    ).write.mode("append").parquet(path)
    return {row["batch_id"]: row["error_code"] for row in coded.collect()}


def with_code(entries: DataFrame) -> DataFrame:
    code = F.when(F.col("status") == "failed", error_code(F.col("error"))).otherwise("")
    return entries.withColumn("error_code", code)


def latest_status(ledger: DataFrame) -> DataFrame:
    """The last entry of each batch; at one time the status that comes later in a batch's life."""
    order = F.struct("ts", F.array_position(F.lit(STATUSES), F.col("status")))
    return ledger.groupBy("batch_id").agg(
        F.max_by("status", order).alias("status"), F.max_by("error_code", order).alias("error_code")
    )


def statuses_of(spark: SparkSession, path: str, batches: list[str]) -> dict[str, str]:
    """The last status of these batches, in one read of the ledger."""
    asked = read_ledger(spark, path).where(F.col("batch_id").isin(batches))
    return {row["batch_id"]: row["status"] for row in latest_status(asked).collect()}


def is_persisted(spark: SparkSession, path: str, batch_id: str) -> bool:
    done = read_ledger(spark, path).where((F.col("batch_id") == batch_id) & (F.col("status") == "persisted"))
    return done.limit(1).count() > 0


def pending(batches: DataFrame, ledger: DataFrame) -> DataFrame:
    """Batches without an entry in the ledger."""
    return batches.join(ledger.select("batch_id"), "batch_id", "left_anti")


def stragglers(batches: DataFrame, ledger: DataFrame, now: Column, max_age_ms: int) -> DataFrame:
    """Batches still without an entry after the given age, as failed entries."""
    late = pending(batches, ledger).where(age_ms(now, F.col("modified")) > max_age_ms)
    return with_code(late.select("batch_id", F.lit("failed").alias("status"), F.lit("not processed").alias("error")))

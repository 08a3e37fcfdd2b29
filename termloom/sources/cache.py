"""A shared, appended table whose rows expire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.scratch import publish

STAMP = "dsctimestamp"
CLEAN_ABOVE_ROWS = 30_000


def check_stamp(df: DataFrame) -> None:
    if dict(df.dtypes).get(STAMP) != T.LongType().simpleString():
        raise ValueError(f"a cached table must hold a long column {STAMP}")


def ttl_cache_append(df: DataFrame, path: str) -> None:
    check_stamp(df)
    df.write.mode("append").parquet(path)


def ttl_cache_read(spark: SparkSession, path: str, now_ms: Column | None = None, ttl_minutes: int = 1440) -> DataFrame:
    """The rows that have not expired, whatever the size of the table; all rows for a time of 0 or less."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    return unexpired(spark.read.parquet(path), now, ttl_minutes)


def unexpired(df: DataFrame, now_ms: Column, ttl_minutes: int) -> DataFrame:
    if ttl_minutes <= 0:
        return df
    return df.where(F.col(STAMP) > now_ms - F.lit(ttl_minutes * 60_000))


def ttl_cache_clean(
    spark: SparkSession, path: str, now_ms: Column, ttl_minutes: int = 1440, above: int = CLEAN_ABOVE_ROWS
) -> bool:
    """Rewrite the cache without expired rows once it is large; the survivors are saved first."""
    if ttl_minutes <= 0 or spark.read.parquet(path).count() <= above:
        return False
    kept = publish(unexpired(spark.read.parquet(path), now_ms, ttl_minutes), "cache")
    kept.write.mode("overwrite").parquet(path)
    return True

"""Exact order statistics and numbering without a single sorting task.

``percentile`` in Spark keeps every distinct value of a group in one buffer, and
an unpartitioned ``row_number`` sorts everything in one task. The functions here
give the same exact answers from bounded pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.lookups import attach, lookup_join
from termloom.scratch import write_table

# Up to this many distinct values, one task sorts a group's counted values.
SMALL_GROUP = 500_000

# A sketch of this accuracy misplaces a rank by at most n / ACCURACY. The
# bracket is ten times wider, so in a larger group it holds every wanted rank.
ACCURACY = 100_000
BRACKET = 1e-4

# Buckets by the leading hex digits of an md5 are even by construction.
HASH_DIGITS = 3
# Hash heads that are counted before the first rows in hash order are taken.
HEAD_DIGITS = 4
INDEX_BUCKET = 65_536


def _value_at_ranks(df: DataFrame, value: str, by: list[str], share: float, ranks: list[Column]) -> DataFrame:
    """Exact values at the given 1-based ranks, all close to ``share`` of ``n``.

    Values are counted first. Where some group has too many distinct values for
    one task, a quantile sketch brackets the wanted ranks: values under the
    bracket are only counted, values inside it are ranked. The rank expressions
    may use the column ``n``.
    """
    data = df.select(*by, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    counted = write_table(data.groupBy(*by, "_v").agg(F.count("*").alias("_c")), "values").table
    sizes = counted.groupBy(*by).agg(F.sum("_c").alias("n"), F.count("*").alias("_d"))
    biggest = sizes.agg(F.max("_d")).first()[0] or 0
    if biggest > SMALL_GROUP:
        counted = _bracketed(data, counted, by, share)
    upto = (
        Window.partitionBy(*by)
        .orderBy(F.col("_v").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = counted.withColumn("_upto", F.sum("_c").over(upto))
    sized = attach(placed, sizes.select(*by, "n"), by)
    picks = [F.min(F.when(F.col("_upto") >= rank, F.col("_v"))).alias(f"_r{i}") for i, rank in enumerate(ranks)]
    return sized.groupBy(*by).agg(F.max("n").alias("n"), *picks)


def _bracketed(data: DataFrame, counted: DataFrame, by: list[str], share: float) -> DataFrame:
    """Counted values with all those under the bracket as one null value, none above it.

    Groups too small to need a bracket pass whole.
    """
    low, high = max(share - BRACKET, 0.0), min(share + BRACKET, 1.0)
    sketch = data.groupBy(*by).agg(
        F.count("*").alias("_n"), F.percentile_approx("_v", [low, high], ACCURACY).alias("_edges")
    )
    marked = attach(counted, sketch, by)
    small = F.col("_n") <= SMALL_GROUP
    inside = small | (F.col("_v") >= F.col("_edges")[0])
    kept = marked.where(small | (F.col("_v") <= F.col("_edges")[1]))
    return kept.groupBy(*by, F.when(inside, F.col("_v")).alias("_v")).agg(F.sum("_c").alias("_c"))


def upper_median(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median") -> DataFrame:
    """The element at position ``n div 2`` (from 0) of the sorted values."""
    by = list(by)
    rank = F.floor(F.col("n") / 2) + 1
    picked = _value_at_ranks(df, value, by, 0.5, [rank])
    return picked.select(*by, F.col("_r0").alias(out))


def percentile_legacy(
    df: DataFrame, value: str, percent: float, by: Sequence[str] = (), out: str = "cut"
) -> DataFrame:
    """Percentile by position ``p(n+1)/100``, interpolated, clamped to min and max."""
    if percent <= 0 or percent > 100:
        raise ValueError("percent must lie in (0, 100]")
    by = list(by)
    position = F.lit(float(percent)) * (F.col("n") + 1) / F.lit(100.0)
    lower = F.greatest(F.lit(1), F.least(F.col("n"), F.floor(position)))
    upper = F.greatest(F.lit(1), F.least(F.col("n"), F.floor(position) + 1))
    picked = _value_at_ranks(df, value, by, percent / 100.0, [lower, upper])
    part = F.when((position < 1) | (position >= F.col("n")), F.lit(0.0)).otherwise(position - F.floor(position))
    return picked.select(*by, (F.col("_r0") + part * (F.col("_r1") - F.col("_r0"))).alias(out))


def _rank_in_buckets(df: DataFrame, by: list[str], bucket: Column, order: list[Column], out: str) -> DataFrame:
    """1-based rank within ``by``, where ``bucket`` grows with the order.

    Ranks inside a bucket come from a window over the bucket; the rows of all
    lower buckets are added from a table of bucket counts.
    """
    data = df.withColumn("_bucket", bucket)
    counts = data.groupBy(*by, "_bucket").agg(F.count("*").alias("_c"))
    before = (
        Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    ranked = data.withColumn("_inside", F.row_number().over(inside))
    joined = lookup_join(ranked, offsets, [*by, "_bucket"])
    return joined.withColumn(out, F.col("_before") + F.col("_inside")).select(*df.columns, out)


def rank_by_hash(df: DataFrame, key: Column, by: Sequence[str] = (), out: str = "rank", seed: str = "") -> DataFrame:
    """Rank rows within ``by`` in the order of ``md5(seed || key)``, then key."""
    digest = F.md5(F.concat(F.lit(seed), key.cast("string")))
    return _rank_in_buckets(df, list(by), F.substring(digest, 1, HASH_DIGITS), [digest, key], out)


def bottom_by_hash(df: DataFrame, key: Column, n: int, seed: str = "") -> DataFrame:
    """The ``n`` rows that come first in the order of ``md5(seed || key)``, then key.

    Rows are counted by the head of their hash, at most 16**HEAD_DIGITS counts.
    Those under the head at which the count reaches ``n`` are a few more than
    ``n``, and only they are shuffled and ranked. Rows without a key take no part.
    """
    digest = F.md5(F.concat(F.lit(seed), key.cast("string")))
    head = F.conv(F.substring(digest, 1, HEAD_DIGITS), 16, 10).cast("int")
    counts = df.where(key.isNotNull()).groupBy(head.alias("head")).agg(F.count("*").alias("c"))
    upto = counts.select("head", F.sum("c").over(Window.orderBy("head")).alias("upto"))
    cut = upto.where(F.col("upto") >= n).agg(F.coalesce(F.min("head"), F.lit(16**HEAD_DIGITS)).alias("cut")).scalar()
    ranked = rank_by_hash(df.where(head <= cut), key, (), "_rank", seed)
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def number_by_hash(names: DataFrame, key: str, out: str = "idx") -> DataFrame:
    """Number distinct names 1, 2, 3, … in hash order.

    A dictionary of bounded size is numbered by one window, a larger one in
    buckets; both give the same numbers.
    """
    written = write_table(names, "names")
    if written.rows > SMALL_GROUP:
        return rank_by_hash(written.table, F.col(key), out=out)
    order = Window.orderBy(F.md5(F.col(key)), F.col(key))
    return written.table.withColumn(out, F.row_number().over(order).cast("long"))


def dense_rank_of_index(df: DataFrame, index: str, out: str = "new_idx") -> DataFrame:
    """Number rows 1, 2, 3, … in the order of a unique integer index."""
    bucket = F.floor(F.col(index) / INDEX_BUCKET)
    return _rank_in_buckets(df, [], bucket, [F.col(index)], out)


def running_before(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """For each row the sum of ``value`` over all rows with a smaller, unique ``order``.

    Rows are written in range partitions of bounded size, each row with the
    number of its part: once written, the parts are data and cannot shift.
    """
    parts = write_table(df, "unordered")
    n_parts = parts.rows // SMALL_GROUP + 1
    ranged = parts.table.repartitionByRange(n_parts, order).withColumn("_part", F.spark_partition_id())
    placed = write_table(ranged, "ordered").table
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(below), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = lookup_join(summed, offsets, ["_part"])
    return joined.withColumn(out, F.col("_before") + F.col("_inside")).select(*df.columns, out)


def first_by_hash(
    df: DataFrame, key: Column, quota: Column, by: Sequence[str] = (), seed: str = ""
) -> DataFrame:
    """Keep, per group, the ``quota`` rows that come first in hash order."""
    ranked = rank_by_hash(df, key, by, "_rank", seed)
    return ranked.where(F.col("_rank") <= quota).drop("_rank")


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group; Spark limits each group before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window).cast("long")).where(F.col(out) <= n)

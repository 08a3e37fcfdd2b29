"""Column (term) statistics and column reduction.

Every function takes an optional ``by`` key list. With ``by=["target"]`` the
same plan computes the statistic for each label separately, so a per-label run
is one plan and not one job chain per label.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.frame import SparseFrame
from termloom.operators.lookups import attach, lookup_join
from termloom.operators.ranking import dense_rank_of_index, percentile_legacy, upper_median
from termloom.scratch import publish, write_table

LOW_PROPORTION = 0.005


def row_totals(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of rows, the denominator that counts empty rows too."""
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"))


def column_sums(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return cells.groupBy(*by, "term").agg(F.sum("value").alias("total"))


def column_proportion(frame: SparseFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with a non-zero value, per term."""
    filled = frame.cells.groupBy(*by, "term").agg(F.count("*").alias("n_cells"))
    shares = attach(filled, row_totals(frame.rows, by), by)
    return shares.select(*by, "term", "n_cells", (F.col("n_cells") / F.col("n_rows")).alias("proportion"))


def column_stddevs(frame: SparseFrame, by: Sequence[str] = ()) -> DataFrame:
    """Population standard deviation per term, an absent cell counting as 0."""
    sums = frame.cells.groupBy(*by, "term").agg(
        F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_q")
    )
    joined = attach(sums, row_totals(frame.rows, by), by)
    mean = F.col("_s") / F.col("n_rows")
    variance = F.greatest(F.col("_q") / F.col("n_rows") - mean * mean, F.lit(0.0))
    return joined.select(*by, "term", F.sqrt(variance).alias("stddev"))


def stddev_cuts(frame: SparseFrame, low: float = 20.0, high: float = 80.0) -> DataFrame:
    """The two percentiles of the column standard deviations."""
    spread = publish(column_stddevs(frame), "stddev")
    lower = percentile_legacy(spread, "stddev", low, out="low_cut")
    return attach(lower, percentile_legacy(spread, "stddev", high, out="high_cut"))


def term_table(spark: SparkSession, terms: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in terms], "term string")


def _restrict_terms(frame: SparseFrame, terms: DataFrame, how: str, by: Sequence[str]) -> SparseFrame:
    keys = write_table(terms.select(*by, "term").distinct(), "terms")
    out = frame.with_cells(lookup_join(frame.cells, keys, [*by, "term"], how))
    if frame.columns is None or by:
        return out
    columns = frame.columns.join(keys.table, "term", how)
    return replace(out, columns=columns)


def remove_columns(frame: SparseFrame, terms: DataFrame, by: Sequence[str] = ()) -> SparseFrame:
    return _restrict_terms(frame, terms, "left_anti", by)


def keep_columns(frame: SparseFrame, terms: DataFrame, by: Sequence[str] = ()) -> SparseFrame:
    return _restrict_terms(frame, terms, "left_semi", by)


def reset_column_indices(columns: DataFrame) -> DataFrame:
    """Number the surviving columns densely from 1, in their old order."""
    return dense_rank_of_index(columns, "idx", "new_idx").select(
        "term", "idx", F.col("new_idx").cast("int").alias("new_idx")
    )


def terms_not_kept(columns: DataFrame, keep: DataFrame) -> DataFrame:
    return columns.select("term").join(keep.select("term"), "term", "left_anti")


def union_terms(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("term").union(right.select("term")).distinct()


def except_terms(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("term").subtract(right.select("term"))


def remove_stop_words(frame: SparseFrame, words: str) -> SparseFrame:
    """Drop the terms of a comma-separated list, ignoring case."""
    wanted = {w.strip().lower() for w in words.split(",") if w.strip()}
    return frame.with_cells(frame.cells.where(~F.lower("term").isin(*sorted(wanted)))) if wanted else frame


def strip_by_prefix(frame: SparseFrame, prefixes: Sequence[str]) -> SparseFrame:
    """Keep only terms that start with one of the markers."""
    marks = "|".join(prefixes)
    return frame.with_cells(frame.cells.where(F.col("term").rlike(f"^({marks})")))


def clean_terms(frame: SparseFrame, cleaner) -> SparseFrame:
    """Rename terms by a Column function; cells that collide are summed."""
    renamed = frame.cells.withColumn("term", cleaner(F.col("term")))
    cells = renamed.groupBy("row_id", "target", "term").agg(F.sum("value").alias("value"))
    return frame.with_cells(cells)


def low_frequency_terms(
    cells: DataFrame, offset: float = 0.0, by: Sequence[str] = (), totals: DataFrame | None = None
) -> DataFrame:
    """Terms whose sum lies under the upper median of sums plus an offset."""
    sums = publish(column_sums(cells, by), "sums") if totals is None else totals
    cut = upper_median(sums, "total", by, "cut")
    return attach(sums, cut, by).where(F.col("total") < F.col("cut") + offset)


def remove_low_frequency(frame: SparseFrame, offset: float = 0.0, by: Sequence[str] = ()) -> SparseFrame:
    return remove_columns(frame, low_frequency_terms(frame.cells, offset, by), by)


def low_percentile_terms(cells: DataFrame, percent: float, by: Sequence[str] = ()) -> DataFrame:
    """Terms whose sum lies under the value at the given percentile of sums."""
    sums = publish(column_sums(cells, by), "sums")
    cut = percentile_legacy(sums, "total", percent, by)
    return attach(sums, cut, by).where(F.col("total") < F.col("cut"))


def remove_low_frequency_percentile(
    frame: SparseFrame, percent: float = 25.0, by: Sequence[str] = ()
) -> SparseFrame:
    if percent <= 0:
        return frame
    return remove_columns(frame, low_percentile_terms(frame.cells, percent, by), by)


def high_frequency_terms(frame: SparseFrame, percent: float = 99.5, by: Sequence[str] = ()) -> DataFrame:
    """Terms whose proportion exceeds the percentile of proportions; a stop-word list."""
    shares = publish(column_proportion(frame, by), "shares")
    cut = percentile_legacy(shares, "proportion", percent, by)
    return attach(shares, cut, by).where(F.col("proportion") > F.col("cut"))


def remove_high_frequency(frame: SparseFrame, percent: float = 99.5, by: Sequence[str] = ()) -> SparseFrame:
    """Drop the terms of too large a share of rows, and list them as stop words of later clustering steps."""
    high = publish(high_frequency_terms(frame, percent, by).select(*by, "term"), "frequent")
    terms = high.select("term") if frame.frequent is None else union_terms(frame.frequent, high)
    return replace(remove_columns(frame, high, by), frequent=terms.distinct())


def without_frequent(frame: SparseFrame) -> SparseFrame:
    """A frame less the terms that earlier steps listed as too frequent, whatever label they were too frequent in."""
    return frame if frame.frequent is None else remove_columns(frame, frame.frequent)


def remove_by_proportion(
    frame: SparseFrame, low: float = LOW_PROPORTION, high: float | None = None, by: Sequence[str] = ()
) -> SparseFrame:
    """Drop terms present in too small (or too large) a share of rows."""
    outside: Column = F.col("proportion") < low
    if high is not None:
        outside = outside | (F.col("proportion") > high)
    return remove_columns(frame, column_proportion(frame, by).where(outside), by)


def reduce_by_tfidf(frame: SparseFrame, percent: float, by: Sequence[str] = ()) -> SparseFrame:
    """Drop from the counts the terms whose tf-idf sum is in the lowest percent.

    Sums are rounded before the cut, so that the same sum added up in another
    order cannot fall on the other side of it.
    """
    from termloom.operators.scale import tfidf

    if percent <= 0:
        return frame
    sums = column_sums(tfidf(frame, by).cells, by).withColumn("total", F.round("total", 9))
    sums = publish(sums, "tfidf-sums")
    cut = percentile_legacy(sums, "total", percent, by)
    low = attach(sums, cut, by).where(F.col("total") < F.col("cut"))
    return remove_columns(frame, low, by)


def validate_columns_match(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """Compare the terms in the data with the dictionary's, as one row."""
    used = cells.select("term").distinct().withColumn("_used", F.lit(True))
    known = columns.select("term").distinct().withColumn("_known", F.lit(True))
    both = used.join(known, "term", "full")
    return both.agg(
        F.count("_used").alias("n_used"),
        F.count("_known").alias("n_known"),
        F.count(F.when(F.col("_used").isNull() | F.col("_known").isNull(), 1)).alias("n_mismatch"),
    ).withColumn("matches", F.col("n_mismatch") == 0)


def wide_sums(wide: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sums of all the columns of a wide table, over all rows or per group."""
    return wide.groupBy(*by).agg(*[F.sum(c).alias(c) for c in columns])


def drop_below_median(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the wide columns whose total lies under the upper median of totals."""
    totals = wide_sums(wide, columns).first().asDict()
    ordered = sorted(v or 0.0 for v in totals.values())
    cut = ordered[len(ordered) // 2]
    return wide.drop(*[c for c in columns if (totals[c] or 0.0) < cut])

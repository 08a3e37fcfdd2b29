"""Label (target) operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.frame import SparseFrame, restrict_cells, restrict_targets
from termloom.functions.text import any_of
from termloom.operators.lookups import attach, lookup_join
from termloom.operators.ranking import first_by_hash, upper_median
from termloom.scratch import publish, write_table


def count_by_target(rows: DataFrame) -> DataFrame:
    return rows.groupBy("target").agg(F.count("*").alias("n_rows"))


def remove_targets(frame: SparseFrame, labels: Sequence[str]) -> SparseFrame:
    unwanted = F.col("target").isin(*labels)
    return frame.with_rows(frame.rows.where(~unwanted), frame.cells.where(~unwanted))


def subset_by_target(frame: SparseFrame, label: str) -> SparseFrame:
    return frame.with_rows(frame.rows.where(F.col("target") == label), frame.cells.where(F.col("target") == label))


def default_label_predicates(name: Column) -> list[Column]:
    """The label names that a trim always drops."""
    return [name.contains("BLANK"), name.startswith("REL"), name == "any subject"]


def trim_targets(
    frame: SparseFrame, min_rows: int = 1000, predicates: Sequence[Column] | None = None
) -> SparseFrame:
    """Drop labels by name or by a row count under ``min_rows``."""
    named = default_label_predicates(F.col("target")) if predicates is None else list(predicates)
    bad = any_of([*named, F.col("n_rows") < min_rows])
    return restrict_targets(frame, count_by_target(frame.rows).where(bad), "left_anti")


def two_targets_above_median(frame: SparseFrame) -> DataFrame:
    """The first two labels, by ascending count, whose count is above the median.

    The median is taken over distinct counts: labels that tie count once.
    """
    counts = publish(count_by_target(frame.rows), "counts")
    cut = upper_median(counts.select("n_rows").distinct(), "n_rows")
    above = attach(counts, cut).where(F.col("n_rows") > F.col("median"))
    return above.orderBy("n_rows", "target").limit(2).select("target", "n_rows")


def keep_two_targets(frame: SparseFrame) -> SparseFrame:
    return restrict_targets(frame, two_targets_above_median(frame), "left_semi")


def balance_targets(frame: SparseFrame, seed: str = "") -> SparseFrame:
    """Sample labels above the upper median count down to the median.

    Rows are taken in hash order; a label's rows are ranked in many buckets, so
    a label with a third of all rows is no single sort.
    """
    cut = publish(upper_median(count_by_target(frame.rows), "n_rows"), "median")
    ranked = attach(frame.rows.select("row_id", "target"), cut)
    kept = first_by_hash(ranked, F.col("row_id"), F.col("median"), ["target"], seed)
    return restrict_cells(frame, kept, "left_semi")


def merge_targets(frame: SparseFrame, merge_map: DataFrame) -> SparseFrame:
    """Relabel by a map of (old, new) names.

    A key matches as ``#`` plus its lower-cased name with blanks for ``_``; a
    pair is ignored when either label is unknown to the data.
    """
    pairs = merge_map.select(
        F.concat(F.lit("#"), F.lower(F.translate("old", "_", " "))).alias("target"),
        F.concat(F.lit("#"), F.lower("new")).alias("_new"),
    )
    return relabel(frame, pairs)


def relabel(frame: SparseFrame, pairs: DataFrame) -> SparseFrame:
    """Apply pairs of known labels (target, _new); one pair per old label."""
    known = publish(frame.rows.select("target").distinct(), "labels")
    usable = (
        pairs.join(known, "target", "left_semi")
        .join(known.withColumnRenamed("target", "_new"), "_new", "left_semi")
        .groupBy("target")
        .agg(F.min("_new").alias("_new"))
    )
    table = write_table(usable, "merge")

    def renamed(df: DataFrame) -> DataFrame:
        joined = lookup_join(df, table, ["target"], "left")
        return joined.withColumn("target", F.coalesce("_new", "target")).select(*df.columns)

    return frame.with_rows(renamed(frame.rows), renamed(frame.cells))


def dichotomize_target(frame: SparseFrame, label: str, other: str = "other") -> SparseFrame:
    """One label against all others."""
    one = F.when(F.col("target") == label, F.col("target")).otherwise(F.lit(other))
    return frame.with_rows(frame.rows.withColumn("target", one), frame.cells.withColumn("target", one))

"""Scaling of cell values, and the bridge between long and wide form."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.frame import SparseFrame
from termloom.operators.columns import column_sums, row_totals
from termloom.operators.lookups import attach, lookup_join

CellOp = Callable[[Column, Column], Column]


def divided_by(cell: Column, constant: Column) -> Column:
    return F.when(constant != 0, cell / constant)


def cell_op_rows(frame: SparseFrame, constant: Callable[[Column], Column], op: CellOp = divided_by) -> SparseFrame:
    """Combine each cell with an aggregate of its row, e.g. ``F.sum``.

    A window by row id: cells that are already partitioned by row id are not
    shuffled again, and one row is at most a vocabulary long.
    """
    whole = Window.partitionBy("row_id")
    joined = frame.cells.withColumn("_constant", constant(F.col("value")).over(whole))
    return frame.with_cells(joined.withColumn("value", op(F.col("value"), F.col("_constant"))))


def cell_op_columns(
    frame: SparseFrame, constants: DataFrame, op: CellOp = divided_by, by: Sequence[str] = ()
) -> SparseFrame:
    """Combine each cell with a per-term constant (by…, term, total).

    Terms are hot keys, so the constants are looked up, not windowed.
    """
    joined = lookup_join(frame.cells, constants, [*by, "term"])
    return frame.with_cells(joined.withColumn("value", op(F.col("value"), F.col("total"))))


def term_frequency(frame: SparseFrame) -> SparseFrame:
    """Cell / row sum."""
    return cell_op_rows(frame, F.sum)


normalize_rows = term_frequency


def idf_weights(frame: SparseFrame, by: Sequence[str] = ()) -> DataFrame:
    """ln(N / df) per term."""
    filled = frame.cells.groupBy(*by, "term").agg(F.count("*").alias("_df"))
    joined = attach(filled, row_totals(frame.rows, by), by)
    return joined.select(*by, "term", F.log(F.col("n_rows") / F.col("_df")).alias("total"))


def inverse_document_frequency(
    frame: SparseFrame, by: Sequence[str] = (), weights: DataFrame | None = None
) -> SparseFrame:
    table = idf_weights(frame, by) if weights is None else weights
    return cell_op_columns(frame, table, lambda cell, idf: cell * idf, by)


def tfidf(frame: SparseFrame, by: Sequence[str] = ()) -> SparseFrame:
    """Cell / row sum, times ln(N / df). Weights come from the unscaled cells."""
    return inverse_document_frequency(term_frequency(frame), by, idf_weights(frame, by))


def normalize_long_rows(frame: SparseFrame) -> SparseFrame:
    """Cell / row sum for few, very long rows: pre-aggregated sums are looked up."""
    sums = frame.cells.groupBy("row_id").agg(F.sum("value").alias("total"))
    joined = lookup_join(frame.cells, sums, ["row_id"])
    return frame.with_cells(joined.withColumn("value", divided_by(F.col("value"), F.col("total"))))


def normalize_rows_then_columns(
    frame: SparseFrame, by: Sequence[str] = (), long_rows: bool = False
) -> SparseFrame:
    scaled = normalize_long_rows(frame) if long_rows else normalize_rows(frame)
    return cell_op_columns(scaled, column_sums(scaled.cells, by), divided_by, by)


def reduce_to_target_by_sum(frame: SparseFrame) -> SparseFrame:
    """Collapse rows to one row per label, cells summed."""
    sums = frame.cells.groupBy("target", "term").agg(F.sum("value").alias("value"))
    cells = sums.select(F.col("target").alias("row_id"), "target", "term", "value")
    labels = frame.rows.select("target").distinct()
    return frame.with_rows(labels.select(F.col("target").alias("row_id"), "target"), cells)


def normalize_and_proportionalize(frame: SparseFrame) -> SparseFrame:
    """One row per label, each cell as share of its row, then of its column."""
    return normalize_rows_then_columns(reduce_to_target_by_sum(frame), long_rows=True)


def dense_pivot(frame: SparseFrame, terms: Sequence[str]) -> DataFrame:
    """Rows as a wide table over a given, bounded vocabulary; absent cells are 0."""
    picked = [F.coalesce(F.sum(F.when(F.col("term") == t, F.col("value"))), F.lit(0.0)).alias(t) for t in terms]
    wide = frame.cells.where(F.col("term").isin(*terms)).groupBy("row_id").agg(*picked)
    joined = frame.rows.select("row_id", "target").join(wide, "row_id", "left")
    return joined.na.fill(0.0, list(terms))


def dense_to_sparse(wide: DataFrame, row_id: str, target: str, columns: Sequence[str]) -> SparseFrame:
    """Columns with a value above 0 become cells; label indices follow frequency."""
    keyed = wide.select(
        F.col(row_id).cast("string").alias("row_id"),
        F.col(target).cast("string").alias("target"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    )
    cells = keyed.unpivot(["row_id", "target"], list(columns), "term", "value").where("value > 0")
    rows = keyed.select("row_id", "target")
    counts = rows.groupBy("target").agg(F.count("*").alias("_n"))
    order = Window.orderBy(F.col("_n").desc(), "target")  # one row per label
    targets = counts.select("target", (F.row_number().over(order) - 1).cast("double").alias("idx"))
    return SparseFrame(rows, cells, None, targets)

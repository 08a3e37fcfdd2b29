"""The sparse data set: four DataFrames that travel together."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import tokens
from termloom.operators.lookups import lookup_join
from termloom.operators.ranking import number_by_hash
from termloom.scratch import publish, write_table

#: Bytes of text that a task counts words of, about: what it holds grows with this and not with the corpus.
TEXT_PART = 4 << 20

#: Cells that a task gathers or sorts by row, about: what it holds grows with this and not with the table.
CELLS_PART = 1 << 17

ROWS_SCHEMA = "row_id string, target string, batch_id string, ts timestamp"
CELLS_SCHEMA = "row_id string, target string, term string, value double"
COLUMNS_SCHEMA = "term string, idx int"
TARGETS_SCHEMA = "target string, idx double"


@dataclass(frozen=True)
class SparseFrame:
    """``rows`` (one per row id), long ``cells``, and the two dictionaries.

    ``rows`` is kept beside ``cells`` because a row that loses all its cells
    still counts in denominators. The dictionaries are built on first need.
    ``frequent`` lists terms that a step took away as too frequent, for all
    labels or for some: clustering steps take them as stop words.
    """

    rows: DataFrame
    cells: DataFrame
    columns: DataFrame | None = None
    targets: DataFrame | None = None
    frequent: DataFrame | None = None

    @property
    def spark(self) -> SparkSession:
        return self.cells.sparkSession

    def with_cells(self, cells: DataFrame) -> SparseFrame:
        return replace(self, cells=cells.select("row_id", "target", "term", "value"))

    def with_rows(self, rows: DataFrame, cells: DataFrame) -> SparseFrame:
        return replace(self, rows=rows, cells=cells)

    def with_columns(self) -> SparseFrame:
        """Number the vocabulary, if not yet done, in hash order from 1."""
        return self if self.columns is not None else replace(self, columns=number_terms(self.cells))

    def with_targets(self) -> SparseFrame:
        return self if self.targets is not None else replace(self, targets=number_targets(self.rows))

    def materialise(self) -> SparseFrame:
        """Write rows and cells once, before several passes over them."""
        return replace(
            self,
            rows=publish(self.rows, "rows"),
            cells=publish(self.cells, "cells"),
        )


def number_terms(cells: DataFrame) -> DataFrame:
    return number_by_hash(cells.select("term").distinct(), "term").select("term", F.col("idx").cast("int").alias("idx"))


def number_targets(rows: DataFrame) -> DataFrame:
    return number_by_hash(rows.select("target").distinct(), "target").select(
        "target", F.col("idx").cast("double").alias("idx")
    )


def empty_frame(spark: SparkSession) -> SparseFrame:
    """The start value of a run that loads nothing."""
    return SparseFrame(
        spark.createDataFrame([], ROWS_SCHEMA),
        spark.createDataFrame([], CELLS_SCHEMA),
        spark.createDataFrame([], COLUMNS_SCHEMA),
        spark.createDataFrame([], TARGETS_SCHEMA),
    )


def text_frame(texts: DataFrame, row_id: str, target: str, text: str) -> SparseFrame:
    """Bag of words of a table of texts.

    The texts themselves are shuffled by row id, once: they are smaller than
    the cells made from them, and every later per-row operator finds its cells
    already co-located.
    """
    keyed = texts.select(
        F.col(row_id).cast("string").alias("row_id"),
        F.col(target).cast("string").alias("target"),
        F.col(text).alias("_text"),
    )
    size = keyed.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    cells = (
        keyed.repartition(max(1, -(-size // TEXT_PART)), "row_id")
        .select("row_id", "target", F.explode(tokens(F.col("_text"))).alias("term"))
        .groupBy("row_id", "target", "term")
        .agg(F.count("*").cast("double").alias("value"))
    )
    return SparseFrame(keyed.select("row_id", "target"), cells)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cell_parts(cells: int) -> int:
    """Partitions by row for so many cells; a number that is named is not cut down to few large ones."""
    return cells // CELLS_PART + 1


def document_frame(spark: SparkSession, sf_dir: str, target: str = "source") -> SparseFrame:
    return text_frame(table(spark, sf_dir, "documents"), "doc_id", target, "text")


def order_frame(spark: SparkSession, sf_dir: str) -> SparseFrame:
    """Orders with lines as rows, priorities as labels, brands as terms, quantities as values.

    Lines meet their part first, are dealt by row id once, and are summed per
    (order, brand) and meet the orders where they are. So the cells stay
    co-located by row.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("term"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("row_id"), F.col("o_orderpriority").alias("target")
    )
    named = lines.join(parts, "l_partkey").select(F.col("l_orderkey").cast("string").alias("row_id"), "term", "l_quantity")
    parts_by_row = cell_parts(lines.count())
    sums = named.repartition(parts_by_row, "row_id").groupBy("row_id", "term").agg(F.sum("l_quantity").alias("value"))
    cells = sums.join(orders.repartition(parts_by_row, "row_id"), "row_id").select("row_id", "target", "term", "value")
    rows = orders.join(lines.select(F.col("l_orderkey").cast("string").alias("row_id")).distinct(), "row_id", "left_semi")
    return SparseFrame(rows, cells.where("value <> 0"))


def restrict_cells(frame: SparseFrame, rows: DataFrame, how: str) -> SparseFrame:
    """Semi or anti join rows and cells with a table of row ids.

    Row ids are unique in ``rows`` and a row holds at most one cell per term, so
    no single id is hot and a plain join is enough. The ids are written once,
    as rows and cells both need them.
    """
    keys = publish(rows.select("row_id"), "ids")
    return frame.with_rows(frame.rows.join(keys, "row_id", how), frame.cells.join(keys, "row_id", how))


def restrict_targets(frame: SparseFrame, targets: DataFrame, how: str) -> SparseFrame:
    keys = write_table(targets.select("target").distinct(), "labels")
    return frame.with_rows(
        lookup_join(frame.rows, keys, ["target"], how), lookup_join(frame.cells, keys, ["target"], how)
    )


def subset_rows_cells(rows: DataFrame, cells: DataFrame, label: str) -> SparseFrame:
    """One label's part of tables written by label."""
    return SparseFrame(
        rows.where(F.col("target") == label),
        cells.where(F.col("target") == label).select("row_id", "target", "term", "value"),
    )

"""The text form of a sparse data set: libsvm lines plus two map files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.frame import SparseFrame
from termloom.functions.text import file_safe
from termloom.operators.lookups import lookup_join
from termloom.scratch import publish, write_table

OUTPUT_DECIMALS = 6


@dataclass(frozen=True)
class Triplet:
    """Parsed lines before names are attached; ``rejects`` holds unreadable lines and those with a number that no map names."""

    lines: DataFrame  # row_id, label, cells array<struct<idx, value>>
    rejects: DataFrame  # row_id, line
    columns: DataFrame
    targets: DataFrame


def read_column_map(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the form ``ColumnHeadTuple(<idx>,<term>)``."""
    form = r"^\s*ColumnHeadTuple\((\d+),(.*)\)\s*$"
    lines = spark.read.text(path).where(F.col("value").rlike(form))
    return lines.select(
        F.regexp_extract("value", form, 2).alias("term"),
        F.regexp_extract("value", form, 1).cast("int").alias("idx"),
    )


def read_target_map(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the form ``(<label>,<number>)``; a label may hold commas."""
    form = r"^\s*\((.*),\s*([-+0-9.Ee]+)\)\s*$"
    lines = spark.read.text(path).where(F.col("value").rlike(form))
    return lines.select(
        F.regexp_extract("value", form, 1).alias("target"),
        F.regexp_extract("value", form, 2).try_cast("double").alias("idx"),
    )


def parse_libsvm(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split text lines (row_id, value) into good rows and rejects. Lines are parsed once and written, as several passes read them."""
    parts = F.split(F.trim("value"), r"\s+")
    cells = F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda p: F.struct(
            F.get(F.split(p, ":"), F.lit(0)).try_cast("int").alias("idx"),
            F.get(F.split(p, ":"), F.lit(1)).try_cast("double").alias("value"),
        ),
    )
    parsed = lines.where(F.length(F.trim("value")) > 0).select(
        "row_id", "value", F.get(parts, F.lit(0)).try_cast("double").alias("label"), cells.alias("cells")
    )
    bad_cell = F.exists("cells", lambda c: c["idx"].isNull() | c["value"].isNull())
    bad = F.coalesce(F.col("label").isNull() | bad_cell, F.lit(True))
    judged = publish(parsed.select("row_id", F.when(bad, F.col("value")).alias("line"), "label", "cells"), "parsed")
    return judged.where("line is null").drop("line"), judged.where("line is not null").select("row_id", "line")


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with an id made from the file and the row's place in its split."""
    place = F.concat_ws("#", F.col("_metadata.file_name"), F.monotonically_increasing_id().cast("string"))
    return spark.read.text(path).select("value", place.alias("row_id"))


def nameless_rows(lines: DataFrame, columns: DataFrame, targets: DataFrame) -> DataFrame:
    """Ids of the rows whose label or one of whose indices no map names; names are matched once per number."""
    used = lines.select("row_id", F.explode("cells.idx").alias("idx"))
    indices = used.select("idx").distinct().join(columns, "idx", "left_anti")
    labels = lines.select("label").distinct().join(targets.withColumnRenamed("idx", "label"), "label", "left_anti")
    by_index = lookup_join(used, indices, ["idx"], "left_semi").select("row_id")
    by_label = lookup_join(lines.select("row_id", "label"), labels, ["label"], "left_semi").select("row_id")
    return by_index.unionByName(by_label).distinct()


def read_libsvm_triplet(spark: SparkSession, data: str, column_map: str, target_map: str) -> Triplet:
    lines, columns, targets = _read_lines(spark, data), read_column_map(spark, column_map), read_target_map(spark, target_map)
    good, rejects = parse_libsvm(lines)
    unknown = write_table(nameless_rows(good, columns, targets), "nameless")
    nameless = lookup_join(lines, unknown, ["row_id"], "left_semi").select("row_id", F.col("value").alias("line"))
    return Triplet(lookup_join(good, unknown, ["row_id"], "left_anti"), rejects.unionByName(nameless), columns, targets)


def to_frame(triplet: Triplet, uid_term: str | None = None) -> SparseFrame:
    """Attach names. With ``uid_term`` that column's value becomes the row id."""
    labels = triplet.targets.withColumnRenamed("idx", "label")
    named = lookup_join(triplet.lines, labels, ["label"])
    if uid_term is not None:
        uid = triplet.columns.where(F.col("term") == uid_term).agg(F.min("idx").alias("_uid")).scalar()
        held = F.filter("cells", lambda c: c["idx"] == F.col("_uid"))
        key = F.get(held, F.lit(0))["value"].cast("long").cast("string")
        named = named.withColumn("_uid", uid).withColumn("row_id", F.coalesce(key, F.col("row_id")))
    long = named.select("row_id", "target", F.inline("cells")).where("value <> 0")
    cells = lookup_join(long, triplet.columns, ["idx"]).select("row_id", "target", "term", "value")
    if uid_term is not None:
        cells = cells.where(F.col("term") != uid_term)
    return SparseFrame(named.select("row_id", "target"), cells, triplet.columns, triplet.targets)


def merge_sparse_batches(frames: Sequence[SparseFrame]) -> SparseFrame:
    """One data set from several, by term and label name.

    The same row id in two sets is one row: its cells are united. Where sets differ
    on a row's label or on the value of a cell, the first set that has it holds.
    """
    parts = [(f.cells.withColumn("_set", F.lit(k)), f.rows.withColumn("_set", F.lit(k))) for k, f in enumerate(frames)]
    cells, rows = parts[0][0], parts[0][1].select("row_id", "target", "_set")
    for more_cells, more_rows in parts[1:]:
        cells = cells.unionByName(more_cells)
        rows = rows.unionByName(more_rows.select("row_id", "target", "_set"))
    labelled = rows.groupBy("row_id").agg(F.min(F.struct("_set", "target"))["target"].alias("target"))
    merged = cells.groupBy("row_id", "term").agg(F.min(F.struct("_set", "value"))["value"].alias("value"))
    return SparseFrame(labelled, merged.join(labelled, "row_id").select("row_id", "target", "term", "value"))


def number_text(value: Column, decimals: int = OUTPUT_DECIMALS) -> Column:
    """A rounded number without exponent and without trailing zeros."""
    plain = F.round(value, decimals).cast(f"decimal(30,{decimals})").cast("string")
    return F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def libsvm_lines(frame: SparseFrame, decimals: int = OUTPUT_DECIMALS) -> DataFrame:
    """``label idx:value …`` per row, indices ascending."""
    frame = frame.with_columns().with_targets()
    indexed = lookup_join(frame.cells, frame.columns, ["term"])
    pair = F.concat_ws(":", F.col("idx").cast("string"), number_text(F.col("value"), decimals))
    per_row = indexed.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("idx", pair.alias("pair")))).alias("_cells")
    )
    labelled = lookup_join(frame.rows.select("row_id", "target"), frame.targets, ["target"])
    joined = labelled.join(per_row, "row_id", "left")
    body = F.array_join(F.transform("_cells", lambda c: c["pair"]), " ")
    return joined.select("row_id", F.concat_ws(" ", number_text(F.col("idx")), body).alias("line"))


def write_libsvm_triplet(frame: SparseFrame, folder: str, name: str, decimals: int = OUTPUT_DECIMALS) -> dict:
    """Write data and maps below ``folder``; returns the three paths."""
    frame = frame.materialise().with_columns().with_targets()
    safe = frame.spark.range(1).select(file_safe(F.lit(name)).alias("n")).first()["n"]
    paths = {part: f"{folder}/{safe}_{part}" for part in ("data", "columnMap", "targetMap")}
    libsvm_lines(frame, decimals).select("line").write.text(paths["data"])
    frame.columns.select(
        F.concat(F.lit("ColumnHeadTuple("), F.col("idx").cast("string"), F.lit(","), "term", F.lit(")"))
    ).write.text(paths["columnMap"])
    frame.targets.select(
        F.concat(F.lit("("), "target", F.lit(","), F.col("idx").cast("string"), F.lit(")"))
    ).write.text(paths["targetMap"])
    return paths

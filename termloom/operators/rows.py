"""Row operators: selection, sampling, hashing and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.frame import SparseFrame, restrict_cells
from termloom.functions.text import decimal_text
from termloom.operators.lookups import attach, lookup_join
from termloom.operators.ranking import bottom_by_hash


def row_sums(cells: DataFrame) -> DataFrame:
    return cells.groupBy("row_id").agg(F.sum("value").alias("total"))


def rows_with_terms(cells: DataFrame, terms: Sequence[str], target: str | None = None) -> DataFrame:
    """Ids of the rows that contain every listed term."""
    hits = cells.where(F.col("term").isin(*terms))
    if target is not None:
        hits = hits.where(F.col("target") == target)
    counted = hits.groupBy("row_id", "target").agg(F.count("*").alias("_n"))
    return counted.where(F.col("_n") == len(set(terms))).select("row_id", "target")


def random_subset(frame: SparseFrame, share: float, seed: int = 1) -> SparseFrame:
    """A share of the rows by a hash of seed and row id: the same rows however the data is partitioned."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("row_id")))
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < int(share * 2**32)
    return restrict_cells(frame, frame.rows.where(drawn), "left_semi")


def hash_sample(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keep keys whose first four md5 digits fall in the first of 65536 buckets."""
    digest = F.md5(F.col(key).cast("string"))
    return df.where(F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") < buckets)


def exact_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """Exactly ``n`` rows, uniform by hash order of the key; only about ``n`` are ever ranked."""
    return bottom_by_hash(df, F.col(key), n, seed)


def limit_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def row_hashes(frame: SparseFrame) -> DataFrame:
    """md5 of label and cells per row, the row id left out.

    A row's cells are at most its vocabulary, so the sorted list stays the size
    of one record.
    """
    text = F.concat_ws(":", "term", decimal_text(F.col("value")))
    per_row = frame.cells.groupBy("row_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col("term"), text.alias("text")))), lambda x: x["text"]
            ),
            " ",
        ).alias("_cells")
    )
    joined = frame.rows.select("row_id", "target").join(per_row, "row_id", "left")
    body = F.concat_ws("|", "target", F.coalesce("_cells", F.lit("")))
    return joined.select("row_id", "target", F.md5(body).alias("row_hash"))


def remove_rows_by_hash(frame: SparseFrame, hashes: DataFrame, keys: Sequence[str] = ("row_hash",)) -> SparseFrame:
    """Drop rows whose content hash is listed."""
    kept = lookup_join(row_hashes(frame), hashes, list(keys), "left_anti")
    return restrict_cells(frame, kept, "left_semi")


def distinct_rows(frame: SparseFrame) -> SparseFrame:
    """Keep the lowest row id of each set of equal rows."""
    first = row_hashes(frame).groupBy("target", "row_hash").agg(F.min("row_id").alias("row_id"))
    return restrict_cells(frame, first, "left_semi")


def analyze_duplicates(frame: SparseFrame) -> DataFrame:
    """Per label: each repeated hash, how often, and its share of the label's rows."""
    copies = row_hashes(frame).groupBy("target", "row_hash").agg(F.count("*").alias("copies"))
    totals = frame.rows.groupBy("target").agg(F.count("*").alias("n_rows"))
    shares = attach(copies.where("copies > 1"), totals, ["target"])
    return shares.select("target", "row_hash", "copies", (F.col("copies") / F.col("n_rows")).alias("share"))


def remove_overrepresented_duplicates(frame: SparseFrame, limit: float) -> SparseFrame:
    """Drop every row whose hash takes more than ``limit`` of its label's rows."""
    over = analyze_duplicates(frame).where(F.col("share") > limit)
    return remove_rows_by_hash(frame, over, ["target", "row_hash"])


def duplicate_analysis(frame: SparseFrame, limit: float = 0.0) -> SparseFrame:
    """Plain de-duplication, or removal of over-represented rows when a limit is set."""
    return distinct_rows(frame) if limit <= 0 else remove_overrepresented_duplicates(frame, limit)

"""Phrase mining: sentences that hold two top terms of one cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.frame import SparseFrame
from termloom.functions.text import label_without_dash
from termloom.operators.lookups import attach, lookup_join
from termloom.operators.ranking import top_per_group
from termloom.scratch import publish, write_table

ALL_TARGETS = "ALL"
LONG_RUN = 8


def last_iteration_terms(clusters: DataFrame) -> DataFrame:
    """Per label the rows of the last iteration; of a long run also its middle one."""
    last = clusters.groupBy("target").agg(F.max("iteration").alias("_last"))
    joined = attach(clusters, last, ["target"])
    middle = (F.col("_last") > LONG_RUN) & (F.col("iteration") == F.floor(F.col("_last") / 2))
    return joined.where((F.col("iteration") == F.col("_last")) | middle).drop("_last")


def top_terms_per_cluster(clusters: DataFrame, n: int) -> DataFrame:
    return top_per_group(clusters, ["target", "cluster"], [F.col("value").desc(), F.col("term")], n)


def term_pairs(top: DataFrame) -> DataFrame:
    """Pairs of a cluster's top terms, the heavier first: n(n-1)/2 per cluster."""
    top = publish(top, "top")
    keys = ["target", "cluster"]
    first = top.select(*keys, F.col("rank").alias("_r1"), F.col("term").alias("term1"), F.col("value").alias("value1"))
    second = top.select(*keys, F.col("rank").alias("_r2"), F.col("term").alias("term2"), F.col("value").alias("value2"))
    pairs = first.join(second, keys).where("_r1 < _r2")
    return pairs.select(
        F.col("target").alias("cluster_target"), "cluster", "term1", "value1", "term2", "value2"
    )


def term_pair_sentences(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows that contain both terms, of the cluster's label unless it is for all.

    Pairs are a report-sized table, so a row has few of their terms. One
    group-by collects those; a row meets its pairs by the first term, and the
    second is looked up in its own list.
    """
    found = write_table(pairs, "pairs")
    wanted = found.table.select(F.col("term1").alias("term")).union(found.table.select("term2"))
    hits = lookup_join(cells.select("row_id", "target", "term"), wanted, ["term"], "left_semi")
    lists = hits.groupBy("row_id", "target").agg(F.collect_set("term").alias("_terms")).where(F.size("_terms") > 1)
    opened = lookup_join(lists.select("*", F.explode("_terms").alias("term1")), found, ["term1"])
    labelled = (F.col("cluster_target") == ALL_TARGETS) | (F.col("cluster_target") == F.col("target"))
    return opened.where(labelled & F.array_contains("_terms", F.col("term2"))).select(
        "row_id", "target", "cluster_target", "cluster", "term1", "value1", "term2", "value2"
    )


def row_names(cells: DataFrame, columns: DataFrame | None = None, unknown: str = "?") -> DataFrame:
    """Terms of a row joined by a blank, in index order (or by name without a dictionary)."""
    if columns is None:
        placed = cells.withColumn("_place", F.col("term"))
    else:
        joined = lookup_join(cells.select("row_id", "idx"), columns, ["idx"], "left")
        placed = joined.withColumn("term", F.coalesce("term", F.lit(unknown))).withColumn("_place", F.col("idx"))
    items = F.array_sort(F.collect_list(F.struct("_place", "term")))
    return placed.groupBy("row_id").agg(F.array_join(F.transform(items, lambda i: i["term"]), " ").alias("names"))


def attach_supplement(phrases: DataFrame, supplement: DataFrame) -> DataFrame:
    """One output row per (pair, sentence) with the sentence's own supplement row."""
    keyed = supplement.withColumnRenamed("uuid", "row_id")
    return phrases.join(keyed, "row_id").withColumn("label", label_without_dash(F.col("aa_label")))


def write_phrases(phrases: DataFrame, path: str, second_tier: bool = False) -> None:
    phrases.withColumn("ran_second_tier", F.lit(second_tier)).write.mode("append").parquet(path)


def union_sentences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Append one list of sentences to another, repeats included."""
    return left.unionByName(right)


def phrase_analysis(frame: SparseFrame, clusters: DataFrame, supplement: DataFrame, top_terms: int = 5) -> DataFrame:
    """Cluster report → last iterations → top terms → sentences → supplement."""
    top = top_terms_per_cluster(last_iteration_terms(clusters), top_terms)
    return attach_supplement(term_pair_sentences(frame.cells, term_pairs(top)), supplement)


def phrase_analysis_by_target(
    frame: SparseFrame, clusters: DataFrame, supplement: DataFrame, top_terms: int = 5
) -> DataFrame:
    """The same over clusters made per label: those for all labels are left out."""
    return phrase_analysis(frame, clusters.where(F.col("target") != ALL_TARGETS), supplement, top_terms)

"""k-means and LDA on sparse frames, and the term selection built on them."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.ml.clustering import LDA, KMeans, KMeansModel, LDAModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.frame import SparseFrame, number_terms, subset_rows_cells
from termloom.operators.columns import keep_columns, remove_columns, remove_stop_words, term_table, without_frequent
from termloom.operators.grouped import REPORT_SCHEMA, VECTOR_CELLS, grouped_trim_cycle
from termloom.operators.lookups import lookup_join
from termloom.operators.ranking import dense_rank_of_index, upper_median
from termloom.operators.scale import tfidf
from termloom.scratch import Written, gathering_by_hash, new_folder, publish, write_table

CLUSTER_SCHEMA = "cluster string, rank int, idx int, value double"
DESCRIBED_TERMS = 60
LDA_MIN_ROWS = 10
SECOND_TIER_MIN_ROWS = 50
#: Between the parts of a composed key.
GROUP_MARK = "\u001f"
VECTOR_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("features", VectorUDT()),
    ]
)


@dataclass(frozen=True)
class Vectors:
    """Rows as written sparse vectors, with the dictionary (term, idx from 0)."""

    rows: DataFrame
    columns: DataFrame


def vectors(frame: SparseFrame) -> Vectors:
    """Assemble sparse vectors, written once because fits read them many times.

    The written struct has the layout of Spark's vector type, so reading it back
    with that type needs no Python. Rows without cells have no vector.
    """
    seen = None
    if frame.columns is None:
        seen = Observation()
        counted = frame.cells.observe(seen, F.count(F.lit(1)).alias("n"))
        numbered = number_terms(counted).withColumnRenamed("idx", "_n")
    else:
        used = publish(frame.cells.select("term").distinct(), "used")
        numbered = dense_rank_of_index(publish(frame.columns.join(used, "term", "left_semi"), "columns"), "idx", "_n")
    columns = write_table(numbered.select("term", (F.col("_n") - 1).cast("int").alias("idx")), "dense")
    return Vectors(pack_vectors(frame.cells, columns, None if seen is None else seen.get["n"]), columns.table)


def pack_vectors(cells: DataFrame, columns: Written, n_cells: int | None = None) -> DataFrame:
    """Cells as vectors over a written dictionary (term, idx from 0).

    A task gathers the rows of about ``VECTOR_CELLS`` of the ``n_cells`` cells, in a hash table that Spark must not sort instead.
    """
    spark = cells.sparkSession
    size = columns.rows
    indexed = lookup_join(cells, columns, ["term"]).select("row_id", "target", "idx", "value")
    parts = max(spark.sparkContext.defaultParallelism, -(-(cells.count() if n_cells is None else n_cells) // VECTOR_CELLS))
    packed = indexed.repartition(parts, "row_id", "target").groupBy("row_id", "target").agg(
        F.sort_array(F.collect_list(F.struct("idx", "value"))).alias("_c")
    )
    layout = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.col("_c.idx").alias("indices"),
        F.col("_c.value").alias("values"),
    )
    path = new_folder(spark, "vectors")
    with gathering_by_hash(spark, VECTOR_CELLS):
        packed.select("row_id", "target", layout.alias("features")).write.parquet(path)
    return spark.read.schema(VECTOR_SCHEMA).parquet(path)


def kmeans_fit(data: Vectors, k: int, iterations: int = 50, init_steps: int = 10, seed: int = 1) -> KMeansModel:
    """k-means|| over all rows; ``model.summary.trainingCost`` is the squared error."""
    return KMeans(k=k, maxIter=iterations, initSteps=init_steps, seed=seed).fit(data.rows)


def lda_fit(
    data: Vectors, topics: int, iterations: int = 20, seed: int = 1, share: float = 1.0, min_rows: int = LDA_MIN_ROWS
) -> LDAModel | None:
    """Online LDA over all rows, or a ``share`` of them by id hash; nothing for ``min_rows`` rows or fewer."""
    if data.rows.limit(min_rows + 1).count() <= min_rows:
        return None
    part = F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000)
    rows = data.rows if share >= 1.0 else data.rows.where(part)
    return LDA(k=topics, maxIter=iterations, optimizer="online", seed=seed).fit(rows)


def top_center_terms(spark: SparkSession, model: KMeansModel, columns: DataFrame, n: int) -> DataFrame:
    """The n highest coordinates of each centre, by name. Centres are model-sized."""
    rows = []
    for cluster, center in enumerate(model.clusterCenters()):
        order = np.lexsort((np.arange(len(center)), -center))[:n]
        rows += [
            (str(cluster), rank + 1, int(i), float(center[i])) for rank, i in enumerate(order) if center[i] != 0
        ]
    return _with_names(spark.createDataFrame(rows, CLUSTER_SCHEMA), columns)


def top_topic_terms(model: LDAModel, columns: DataFrame, n: int) -> DataFrame:
    """The first n of the described terms of each topic, by name."""
    topics = model.describeTopics(max(n, DESCRIBED_TERMS)).select(
        F.col("topic").cast("string").alias("cluster"),
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("_p", "_t"),
    )
    rows = topics.select(
        "cluster",
        (F.col("_p") + 1).alias("rank"),
        F.col("_t.termIndices").alias("idx"),
        F.col("_t.termWeights").alias("value"),
    )
    return _with_names(rows.where(F.col("rank") <= n), columns)


def _with_names(report: DataFrame, columns: DataFrame) -> DataFrame:
    return columns.join(F.broadcast(report), "idx").select("cluster", "rank", "term", "value")


def term_spread(cluster_terms: DataFrame) -> DataFrame:
    """In how many clusters a term appears, counted from 0."""
    return cluster_terms.groupBy("term").agg((F.count("*") - 1).alias("spread"))


def cluster_weight_stats(cluster_terms: DataFrame) -> DataFrame:
    """Largest, mean and middle (of the descending order) weight per cluster."""
    stats = cluster_terms.groupBy("cluster").agg(
        F.max("value").alias("max_value"), F.avg("value").alias("mean_value"), F.count("*").alias("n_terms")
    )
    ordered = cluster_terms.select("cluster", (-F.col("value")).alias("_neg"))
    middle = upper_median(ordered, "_neg", ["cluster"], "_mid")
    return stats.join(middle, "cluster").select(
        "cluster", "n_terms", "max_value", "mean_value", (-F.col("_mid")).alias("mid_value")
    )


@dataclass(frozen=True)
class CycleSettings:
    k: int = 20
    iterations: int = 50
    init_steps: int = 10
    top_terms: int = 15
    spread: int = 2
    max_rounds: int | None = None  # a cycle ends by itself; 1 for a single, non-recursive round
    stop_words: str = ""


def _one_round(frame: SparseFrame, method: str, settings: CycleSettings) -> DataFrame | None:
    data = vectors(frame)
    if data.rows.isEmpty():
        return None
    if method == "kmeans":
        model = kmeans_fit(data, settings.k, settings.iterations, settings.init_steps)
        return top_center_terms(frame.spark, model, data.columns, settings.top_terms)
    topics = lda_fit(data, settings.k, settings.iterations)
    return None if topics is None else top_topic_terms(topics, data.columns, settings.top_terms)


def without_stop_words(frame: SparseFrame, settings: CycleSettings) -> SparseFrame:
    """A frame less the stop words of the settings and the terms that earlier steps found too frequent."""
    return without_frequent(remove_stop_words(frame, settings.stop_words))


def trim_cycle(frame: SparseFrame, method: str, settings: CycleSettings, target: str = "ALL") -> DataFrame:
    """Fit, report, remove terms spread over too many clusters, and fit again.

    Every round but the last removes at least one term, so the cycle ends, at
    the latest with the vocabulary. Each round starts from the same written cells less all terms removed so far,
    so the lineage does not grow. Only report-sized lists reach the driver.
    Returns the report rows of all rounds; their terms are the ones to keep.
    """
    spark = frame.spark
    base = frame.materialise()
    removed: set[str] = set()
    reports: list[DataFrame] = []
    stop_at = 0 if method == "kmeans" else 1
    for iteration in count():
        if iteration == settings.max_rounds:
            break
        current = remove_columns(base, term_table(spark, sorted(removed))) if removed else base
        report = _one_round(current, method, settings)
        if report is None:
            break
        report = publish(report, "report")
        reports.append(
            report.select(F.lit(target).alias("target"), F.lit(iteration).alias("iteration"), "cluster", "rank", "term", "value")
        )
        wide = {r["term"] for r in term_spread(report).where(F.col("spread") > settings.spread).collect()}
        if len(wide) <= stop_at:
            break
        removed |= wide
    if not reports:
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = reports[0]
    for more in reports[1:]:
        out = out.unionByName(more)
    return out


def kmeans_trim_cycle(frame: SparseFrame, settings: CycleSettings = CycleSettings(), target: str = "ALL") -> DataFrame:
    weighted = tfidf(without_stop_words(frame, settings))
    return trim_cycle(weighted.with_cells(weighted.cells.where("value <> 0")), "kmeans", settings, target)


def lda_trim_cycle(frame: SparseFrame, settings: CycleSettings = CycleSettings(), target: str = "ALL") -> DataFrame:
    return trim_cycle(without_stop_words(frame, settings), "lda", settings, target)


def cycle_by_target(frame: SparseFrame, method: str, settings: CycleSettings) -> DataFrame:
    """Run a cycle per label; without labels the report is empty.

    k-means goes through all labels together. LDA loops over the label
    dictionary; each label's fit is itself a distributed job over the label's
    partition of one written table, so a label with a third of all rows needs
    no single task.
    """
    if method == "kmeans":
        weighted = tfidf(without_stop_words(frame, settings).materialise(), ["target"])
        return _grouped(weighted.cells.where("value <> 0"), settings)
    frame = without_stop_words(frame, settings)
    rows = publish(frame.rows.select("row_id", "target"), "rows", ["target"])
    cells = publish(frame.cells.select("row_id", "term", "value", "target"), "cells", ["target"])
    out = frame.spark.createDataFrame([], REPORT_SCHEMA)
    for label in [r["target"] for r in rows.select("target").distinct().orderBy("target").collect()]:
        out = out.unionByName(lda_trim_cycle(subset_rows_cells(rows, cells, label), settings, label))
    return out


def _grouped(cells: DataFrame, settings: CycleSettings) -> DataFrame:
    return grouped_trim_cycle(cells, settings.k, settings.iterations, settings.top_terms, settings.spread, settings.max_rounds)


def reduce_by_clustering(frame: SparseFrame, settings: CycleSettings = CycleSettings()) -> SparseFrame:
    """Keep the terms that either method reports."""
    found = kmeans_trim_cycle(frame, settings).unionByName(lda_trim_cycle(frame, settings))
    return keep_columns(frame, found.select("term"))


def reduce_by_clustering_by_target(frame: SparseFrame, settings: CycleSettings = CycleSettings()) -> SparseFrame:
    """The same per label: a term is kept in the labels where it was reported."""
    frame = frame.materialise()
    found = cycle_by_target(frame, "kmeans", settings).unionByName(cycle_by_target(frame, "lda", settings))
    return keep_columns(frame, found.select("target", "term"), ["target"])


def second_tier_clusters(
    frame: SparseFrame, phrases: DataFrame, k: int = 2, top_terms: int = 10, min_rows: int = SECOND_TIER_MIN_ROWS
) -> DataFrame:
    """Cluster again, without recursion, the sentences mined from each cluster: all clusters together.

    A sentence mined from several clusters takes part in each of them.
    """
    group = F.concat_ws(GROUP_MARK, "cluster_target", "cluster")
    mined = publish(phrases.select(group.alias("_group"), "row_id").distinct(), "mined")
    large = mined.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") > min_rows)
    members = publish(lookup_join(mined, large, ["_group"]).select("_group", "row_id"), "members")
    own = F.concat_ws(GROUP_MARK, "_group", "row_id").alias("row_id")
    rows = members.select(own, F.col("_group").alias("target"))
    cells = without_frequent(frame).cells.select("row_id", "term", "value").join(members, "row_id").select(own, F.col("_group").alias("target"), "term", "value")
    weighted = tfidf(frame.with_rows(rows, publish(cells, "cells")), ["target"])
    report = _grouped(
        weighted.cells.where("value <> 0"), CycleSettings(k=k, iterations=10, top_terms=top_terms, max_rounds=1)
    )
    return report.select(
        F.regexp_replace("target", f"{GROUP_MARK}[^{GROUP_MARK}]*$", "").alias("target"),
        F.substring_index("target", GROUP_MARK, -1).alias("parent"), "cluster", "rank", "term", "value",
    )

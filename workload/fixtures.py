"""Tables that Spark derives from the test tables and several queries share.

Each is built once per session and scale in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.frame import SparseFrame, cell_parts, order_frame, table
from termloom.scratch import new_folder, publish
from termloom.sources import folders
from termloom.sources.store import BATCH_TABLES, Store, StoreConfig, append_batch, append_supplement, create_empty, create_store, create_supplement, scan

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
STORE_UUID = "0f8fad5b-d9cb-469f-a165-70867728950e"
_MADE: dict = {}


def once(make: Callable):
    @wraps(make)
    def get(spark: SparkSession, d: str):
        key = (make.__name__, spark.sparkContext.applicationId, d)
        if key not in _MADE:
            _MADE[key] = make(spark, d)
        return _MADE[key]

    return get


def now():
    return F.expr(NOW)


def uid_cells(rows: DataFrame, *more: str) -> DataFrame:
    """One cell per row of orders that holds its old numeric id."""
    return rows.select("row_id", "target", F.lit("A_UID").alias("term"), (F.col("row_id").cast("double") + 1).alias("value"), *more)


def with_uid(frame: SparseFrame) -> SparseFrame:
    """A frame of orders plus one cell per row that holds its old numeric id."""
    return SparseFrame(frame.rows, frame.cells.unionByName(uid_cells(frame.rows)))


def order_frame_with_uid(spark: SparkSession, d: str) -> SparseFrame:
    """The order frame plus one cell per row that holds its old numeric id."""
    return with_uid(order_frame(spark, d))


def by_status(spark: SparkSession, d: str, frame: SparseFrame, finished: bool) -> SparseFrame:
    status = F.col("o_orderstatus") == "F"
    ids = table(spark, d, "orders").where(status if finished else ~status).select(
        F.col("o_orderkey").cast("string").alias("row_id")
    )
    return SparseFrame(
        frame.rows.join(ids, "row_id", "left_semi"), frame.cells.join(ids, "row_id", "left_semi")
    )


@once
def order_store(spark: SparkSession, d: str) -> Store:
    """Orders ingested as two batches, finished ones first.

    Cells stay where ``order_frame`` dealt them by row, and ids are made from the
    written rows, so neither is shuffled again to learn its batch.
    """
    store = Store(spark, new_folder(spark, "store"), "orders", StoreConfig(permitted_duplicates=0.9))
    create_store(store, STORE_UUID)
    frame = order_frame(spark, d)
    status = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("row_id"), (F.col("o_orderstatus") == "F").alias("finished"))
    parts = cell_parts(table(spark, d, "lineitem").count())
    dealt = status.repartition(parts, "row_id")
    rows = publish(frame.rows.repartition(parts, "row_id").join(dealt, "row_id"), "by-status")
    cells = publish(frame.cells.join(dealt, "row_id"), "by-status")
    for batch, finished in (("batch-f", F.col("finished")), ("batch-op", ~F.col("finished"))):
        append_batch(store, with_uid(SparseFrame(rows.where(finished).drop("finished"), cells.where(finished).drop("finished"))), batch, now())
    supplement = document_supplement(spark, d)
    create_supplement(store, supplement)
    append_supplement(store, supplement, "batch-docs", now())
    return store


def copy_of(store: Store) -> Store:
    """The store's tables written again below a fresh folder, for queries that change them.

    Batch by batch: dealing rows out by the batch would sort all of them.
    """
    out = Store(store.spark, new_folder(store.spark, "store"), store.name, store.config)
    create_empty(out)
    for name in BATCH_TABLES:
        for batch in (n for n in folders.names(store.spark, store.path(name)) if n.startswith("batch_id=")):
            part = store.spark.read.parquet(f"{store.path(name)}/{batch}")
            part.write.parquet(f"{out.path(name)}/{batch}")
    scan(store, "identity").write.parquet(out.path("identity"))
    return out


def document_supplement(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("uuid"), F.col("source").alias("aa_label"), F.col("text").alias("rawsentence")
    )


def order_supplement(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("uuid"),
        F.concat("o_orderpriority", F.lit("-")).alias("aa_label"),
        F.concat_ws(" ", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("rawsentence"),
    )


ORDER_SUPPLEMENT = """sup AS (SELECT CAST(o_orderkey AS VARCHAR) AS row_id, o_orderpriority || '-' AS aa_label,
  o_orderstatus || ' ' || strftime(o_orderdate, '%Y-%m-%d') AS rawsentence FROM orders)"""


def cluster_report(spark: SparkSession, d: str) -> DataFrame:
    """A cluster report summed from the lines: per priority and for all, by year and brand."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("term"))
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", (F.year("o_orderdate") - 1990).alias("iteration")
    )
    sums = (
        lines.join(parts, "l_partkey")
        .join(orders, "l_orderkey")
        .groupBy("o_orderpriority", "iteration", "term")
        .agg(F.sum("l_quantity").alias("value"))
    )
    per = publish(sums, "sums")
    each = per.select(F.col("o_orderpriority").alias("target"), "iteration", "term", "value")
    whole = per.groupBy("iteration", "term").agg(F.sum("value").alias("value")).select(
        F.lit("ALL").alias("target"), "iteration", "term", "value"
    )
    number = F.substring("term", 7, 2).cast("int")
    report = each.unionByName(whole).select(
        "target", "iteration", F.concat(F.lit("c_"), (number % 3).cast("string")).alias("cluster"), "term", "value"
    )
    return publish(report, "report")


CLUSTERS = """per AS (SELECT o_orderpriority, CAST(year(o_orderdate) - 1990 AS INTEGER) AS iteration, p_brand AS term, sum(l_quantity) AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
  report AS (SELECT target, iteration, 'c_' || (CAST(substr(term, 7, 2) AS INTEGER) % 3) AS cluster, term, value FROM (
    SELECT o_orderpriority AS target, iteration, term, value FROM per
    UNION ALL SELECT 'ALL', iteration, term, sum(value) FROM per GROUP BY iteration, term))"""

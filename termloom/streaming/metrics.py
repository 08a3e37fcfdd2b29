"""Progress of streaming queries as a table, written event by event by a listener."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from termloom.sources import folders

PROGRESS_SCHEMA = "run string, batch bigint, rows bigint, delay_ms bigint, failed int"
RECENT = 10


class ProgressLog(StreamingQueryListener):
    """Appends each progress event, and each failure, of all queries to the table below ``path``.

    An event is one small file named by run and micro-batch, so an event told
    twice is one row. Nothing is kept in memory, however long a query runs.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}
        folders.make(spark, path)

    def _write(self, run: str, batch: int, rows: int, delay: int, failed: int, label: str) -> None:
        entry = {"run": run, "batch": batch, "rows": rows, "delay_ms": delay, "failed": failed}
        folders.write_text(self.spark, f"{self.path}/{run}-{label}.json", json.dumps(entry))

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        done = event.progress
        self._write(str(done.runId), done.batchId, done.numInputRows, done.durationMs.get("triggerExecution", 0), 0, f"{done.batchId:012d}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        if event.exception is not None:
            self._write(run, -1, 0, 0, 1, "failed")
        self._end(run).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all events of an ended query are written; events come in order, its end last."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("The end of the query was not told")


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).json(path)


def stream_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Micro-batches that brought rows, their rows, failures, and the mean delay of the last ten, over all that was logged."""
    log = progress_table(spark, path)
    brought = log.where("rows > 0")
    totals = log.agg(
        F.count(F.when(F.col("rows") > 0, 1)).alias("completed"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
    )
    last = brought.orderBy(F.desc("batch")).limit(RECENT).agg(F.avg("delay_ms").alias("mean_delay_ms"))
    return totals.withColumn("mean_delay_ms", last.scalar())

"""Checked ingestion with staging, promotion, and folders for what was processed.

The unit is the announced batch, not the micro-batch. What arrives is landed in
one folder per batch, so a micro-batch reads only the batches it touches, and
results do not depend on how files were dealt to triggers.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termloom.frame import SparseFrame
from termloom.operators.columns import remove_columns, remove_low_frequency, term_table
from termloom.sources import folders, ledger
from termloom.sources.batches import age_ms
from termloom.sources.store import (
    Store, append_batch, append_supplement, create_store, create_supplement, finish_swaps, is_own_uuid, overwrite_store, partition_value,
    put_supplement, scan, scan_store, store_exists,
)

CELL_STREAM_SCHEMA = "batch_id string, row_id string, target string, term string, value double"
CYCLE_SCHEMA = (
    "batch_id string, kind string, batch_uuid string, announced long, modified timestamp, "
    "row_id string, target string, term string, value double, uuid string, aa_label string, rawsentence string"
)
SUPPLEMENT_COLUMNS = ["uuid", "aa_label", "rawsentence"]
PROMOTE_AFTER_HOURS = 12
BATCH_FOLDER = "batch_id="
#: Files that a task may have open while it deals rows out to their batches; rows of further batches are sorted.
OPEN_FILES, OPEN_FILES_KEY = 8, "spark.sql.maxConcurrentOutputFileWriters"


def stream_cells(spark: SparkSession, path: str, max_files: int | None = None, schema: str = CELL_STREAM_SCHEMA) -> DataFrame:
    """Stream of announced cells; ``max_files`` sets the size of a micro-batch, never the result."""
    reader = spark.readStream.schema(schema)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).parquet(path)


def take_in(store: Store, cells: DataFrame, batch_id: str, now: Column, store_uuid: str | None = None) -> tuple[str, str]:
    """(status, error) of one sparse batch; a failure is told, not raised on, and changes nothing in the store."""
    try:
        frame = SparseFrame(cells.select("row_id", "target").distinct(), cells.where("value <> 0"))
        result = append_batch(store, frame, batch_id, now, store_uuid)
    except Exception as problem:  # one bad batch must not stop the others
        return "failed", str(problem)
    return result["status"], result["error"]


def ingest_batch(
    store: Store, cells: DataFrame, batch_id: str, ledger_path: str, now: Column, grown: bool = False,
    store_uuid: str | None = None,
) -> str:
    """Take in one batch unless the ledger says it is in and it has not ``grown``; failures are recorded."""
    if not grown and ledger.is_persisted(store.spark, ledger_path, batch_id):
        return "skipped"
    status, error = take_in(store, cells, batch_id, now, store_uuid)
    ledger.record(store.spark, ledger_path, batch_id, status, error, now)
    return status


def land(micro: DataFrame, epoch: int, landing: str) -> list[str]:
    """Move what arrived to ``landing/batch_id=…/epoch=…``; returns the folders of the batches it belongs to.

    The same epoch once more puts the same files in place of what it left. A task
    keeps a file open for each of its batches: with so few it need not sort its rows.
    """
    spark = micro.sparkSession
    arriving = f"{landing}/_arriving/epoch={epoch}"
    before = spark.conf.get(OPEN_FILES_KEY)
    spark.conf.set(OPEN_FILES_KEY, str(OPEN_FILES))
    try:
        micro.write.mode("overwrite").partitionBy("batch_id").parquet(arriving)
    finally:
        spark.conf.set(OPEN_FILES_KEY, before)
    touched = folders.names(spark, arriving)
    for batch in touched:
        folders.move(spark, f"{arriving}/{batch}", f"{landing}/{batch}/epoch={epoch}")
    folders.drop(spark, arriving)
    return touched


def batch_of(folder: str) -> str:
    return unquote(folder.removeprefix(BATCH_FOLDER))


def stream_ingest(
    cells: DataFrame, store: Store, store_uuid: str, ledger_path: str, checkpoint: str, now: Column
) -> StreamingQuery:
    """Ingest announced sparse batches one after the other; replays are no-ops by batch id.

    A batch that gets further files is taken in again with all its files, in
    place of what stood under its id.
    """
    spark = cells.sparkSession
    create_store(store, store_uuid)
    ledger.create_ledger(spark, ledger_path)
    landing = f"{checkpoint}-landed"

    def sink(micro: DataFrame, epoch: int) -> None:
        for folder in land(micro, epoch, landing):
            part = spark.read.schema(CELL_STREAM_SCHEMA).parquet(f"{landing}/{folder}").drop("batch_id")
            grown = len(folders.names(spark, f"{landing}/{folder}")) > 1
            ingest_batch(store, part, batch_of(folder), ledger_path, now, grown, store_uuid)

    return _each(cells, sink, checkpoint)


def _each(stream: DataFrame, sink, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@dataclass(frozen=True)
class Cycle:
    """Where a cycle works: the two stores, their uuid, the ledger, the landed batches, and what was processed.

    ``done`` gets the folders ``persisted/``, ``failed/<code>/`` and ``late/``.
    """

    staging: Store
    final: Store
    store_uuid: str
    ledger_path: str
    landing: str
    done: str
    late_after_ms: int


def stream_cycle(batches: DataFrame, cycle: Cycle, checkpoint: str, now: Column) -> StreamingQuery:
    """Run a whole cycle per micro-batch: sparse batches, supplements, promotion, stragglers.

    Rows carry the batch's kind (``data`` or ``supplement``), the store uuid it
    announces and its number of rows; a batch is processed once all have landed.
    The ledger tells each batch's way: arrived, persisted, promoted, or failed or
    late. Every step may be done again after an interruption.
    """
    create_store(cycle.staging, cycle.store_uuid)
    ledger.create_ledger(batches.sparkSession, cycle.ledger_path)
    return _each(batches, lambda micro, epoch: run_cycle(micro, epoch, cycle, now), checkpoint)


def run_cycle(micro: DataFrame, epoch: int, cycle: Cycle, now: Column) -> None:
    spark = micro.sparkSession
    touched = list(map(batch_of, land(micro, epoch, cycle.landing)))
    finish_swaps(cycle.staging)
    known = ledger.statuses_of(spark, cycle.ledger_path, list(map(batch_of, folders.names(spark, cycle.landing))))
    for batch, status in known.items():
        if status in ("persisted", "promoted"):  # taken in already: what has landed again changes nothing
            folders.drop(spark, _landed(cycle, batch))
    fresh = [b for b in touched if b not in known]
    ledger.record_all(spark, cycle.ledger_path, [(b, "arrived", "") for b in fresh], now)
    waiting = _waiting(spark, cycle, now)
    for kind, take in (("data", _take_data), ("supplement", _take_supplement)):
        results = [(row["batch_id"], *take(cycle, row, now)) for row in waiting if row["whole"] and row["kind"] == kind]
        codes = ledger.record_all(spark, cycle.ledger_path, results, now)
        for batch, status, _ in results:
            _put_away(spark, cycle, batch, status, codes[batch])
    _promote(spark, cycle, epoch, now)
    late = [(row["batch_id"], "late", "not complete in time") for row in waiting if not row["whole"] and row["old"]]
    ledger.record_all(spark, cycle.ledger_path, late, now)
    for batch, _, _ in late:
        _put_away(spark, cycle, batch, "late", "")


def _folder(batch: str) -> str:
    return f"{BATCH_FOLDER}{partition_value(batch)}"


def _landed(cycle: Cycle, batch: str) -> str:
    return f"{cycle.landing}/{_folder(batch)}"


def _waiting(spark: SparkSession, cycle: Cycle, now: Column) -> list:
    """The landed batches, in order: kind, uuid, whether all rows are there, whether the last is too old."""
    if not folders.names(spark, cycle.landing):
        return []
    landed = spark.read.schema(CYCLE_SCHEMA).parquet(cycle.landing)
    state = landed.groupBy("batch_id").agg(
        F.max("kind").alias("kind"), F.max("batch_uuid").alias("batch_uuid"),
        (F.count("*") >= F.max("announced")).alias("whole"),
        (age_ms(now, F.max("modified")) > F.lit(cycle.late_after_ms)).alias("old"),
    )
    return state.where("batch_id is not null").orderBy("batch_id").collect()


def _take_data(cycle: Cycle, row, now: Column) -> tuple[str, str]:
    cells = cycle.staging.spark.read.schema(CYCLE_SCHEMA).parquet(_landed(cycle, row["batch_id"]))
    return take_in(cycle.staging, cells.select("row_id", "target", "term", "value"), row["batch_id"], now, row["batch_uuid"])


def _take_supplement(cycle: Cycle, row, now: Column) -> tuple[str, str]:
    rows = cycle.staging.spark.read.schema(CYCLE_SCHEMA).parquet(_landed(cycle, row["batch_id"])).select(*SUPPLEMENT_COLUMNS)
    try:
        if not is_own_uuid(cycle.staging, row["batch_uuid"]):
            return "failed", "The batch is for another store"
        create_supplement(cycle.staging, rows)
        append_supplement(cycle.staging, rows, row["batch_id"], now)
    except Exception as problem:  # one bad batch must not stop the others
        return "failed", str(problem)
    return "persisted", ""


def _put_away(spark: SparkSession, cycle: Cycle, batch: str, status: str, code: str) -> None:
    """Move a processed batch's folder; a taken-in one is kept only if the store archives."""
    if status == "persisted" and not cycle.staging.config.archive:
        folders.drop(spark, _landed(cycle, batch))
        return
    place = f"failed/{code or 'unknown'}" if status == "failed" else status
    folders.move(spark, _landed(cycle, batch), f"{cycle.done}/{place}/{_folder(batch)}")


def _promote(spark: SparkSession, cycle: Cycle, epoch: int, now: Column) -> None:
    """Promote what waits, if it is time, and say so of the batches it came from."""
    result = promote_staging(cycle.staging, cycle.final, cycle.store_uuid, cycle.ledger_path, f"promotion-{epoch}", now)
    if result == "promoted":
        held = ledger.latest_status(ledger.read_ledger(spark, cycle.ledger_path)).where("status = 'persisted'")
        moved = [row["batch_id"] for row in held.where(~F.col("batch_id").startswith("promotion-")).collect()]
        ledger.record_all(spark, cycle.ledger_path, [(b, "promoted", "") for b in moved], now)


def is_aged(data: DataFrame, now: Column, hours: int = PROMOTE_AFTER_HOURS) -> DataFrame:
    """Rows waiting, last arrival, and whether that is over ``hours`` ago."""
    stats = data.agg(F.count("*").alias("n_rows"), F.max("ts").alias("last_ts"))
    late = F.unix_timestamp("last_ts") < F.unix_timestamp(now) - F.lit(hours * 3600)
    return stats.withColumn("due", F.coalesce(late, F.lit(False)) & (F.col("n_rows") > 0))


def promoted_frame(staging: Store) -> SparseFrame:
    """What a promotion takes over: trimmed if the store says so, without the uid term."""
    frame = scan_store(staging).materialise()
    if staging.config.trim:
        frame = remove_low_frequency(frame)
    return remove_columns(frame, term_table(staging.spark, [staging.config.uid_column]))


def has_supplement(store: Store) -> bool:
    return store_exists(store, "supplement") and not scan(store, "supplement").isEmpty()


def promote_staging(
    staging: Store, final: Store, store_uuid: str, ledger_path: str, batch_id: str, now: Column, force: bool = False
) -> str:
    """Move staged rows on when there are enough of them.

    A store with ``flush`` off is never promoted; one with ``supplement`` on waits
    for its supplement.

    The final store is written first, then the ledger, and only then is staging
    emptied; after a failure staging stays as it is.
    """
    spark = staging.spark
    if not staging.config.flush:
        return "off"
    if staging.config.supplement and not has_supplement(staging):
        return "waiting"
    waiting = scan(staging, "data").count()
    if waiting == 0 or (not force and waiting <= staging.config.flush_threshold):
        return "waiting"
    create_store(final, store_uuid)
    ledger.create_ledger(spark, ledger_path)
    if not ledger.is_persisted(spark, ledger_path, batch_id):
        result = append_batch(final, promoted_frame(staging), batch_id, now)
        if result["status"] == "persisted" and store_exists(staging, "supplement"):
            put_supplement(final, scan(staging, "supplement"), batch_id)
        ledger.record(spark, ledger_path, batch_id, result["status"], result["error"], now)
        if result["status"] != "persisted":
            return "failed"
    overwrite_store(staging, store_uuid)
    return "promoted"


def promote_aged(
    staging: Store, final: Store, store_uuid: str, ledger_path: str, batch_id: str, now: Column
) -> str:
    """Promote below the threshold too, once nothing has arrived for a while."""
    if not is_aged(scan(staging, "data"), now).first()["due"]:
        return "waiting"
    return promote_staging(staging, final, store_uuid, ledger_path, batch_id, now, force=True)

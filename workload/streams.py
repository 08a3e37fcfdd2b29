"""Queries on streaming and on runs of steps."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from termloom.frame import SparseFrame, cell_parts, document_frame, empty_frame, order_frame, table
from termloom.operators import columns as C
from termloom.operators import scale as X
from termloom.operators.clusters import CycleSettings
from termloom.plans import presets, steps
from termloom.scratch import new_folder
from termloom.sources import ledger
from termloom.sources import store as S
from termloom.sources.batches import list_files
from termloom.sources.tables import read_header_csv
from termloom.streaming import ingest, metrics, receive
from workload.columns import cells_out
from workload.fixtures import STORE_UUID, document_supplement, now, once, order_frame_with_uid, order_supplement, uid_cells
from workload.registry import CELLS_OUT, DOCS, ORDERS, doc_ctes, legacy_cut, median_cut, query
from workload.rows import HASH_LABELS, MERGED, hash_labels
from workload.store import CODED, STORE_CELLS, coded_csv

LANG = doc_ctes("lang")


@once
def inbox(spark, d):
    """One announced data set per event type, its control lines among its data lines.

    Errors are announced without a store, sign-ups as a supplement.
    """
    events = table(spark, d, "events")
    data = events.select("event_type", F.concat_ws(",", "event_id", "user_id", "props").alias("value"))
    kinds = events.select("event_type").distinct()
    name = F.when(F.col("event_type") == "signup", F.concat("event_type", F.lit("supplement"))).otherwise(F.col("event_type"))
    store = F.when(F.col("event_type") != "error", F.concat(F.lit("DATA_STORE=st_"), F.col("event_type")))
    lines = F.array_compact(
        F.array(
            F.concat(F.lit("DATA_NAME="), name), store, F.concat(F.lit("STORE_UUID=uuid-"), F.col("event_type")), F.lit(""), F.lit("END_STREAM")
        )
    )
    control = kinds.select("event_type", F.explode(lines).alias("value"))
    path = new_folder(spark, "inbox")
    data.unionByName(control).write.partitionBy("event_type").text(path)
    return path


EVENT_LINES = "SELECT event_id || ',' || user_id || ',' || props AS value, event_type FROM events"


@query("stream_lines", f"""SELECT value, count(*) AS n FROM (SELECT value FROM ({EVENT_LINES})
UNION ALL SELECT 'DATA_NAME=' || event_type || CASE WHEN event_type = 'signup' THEN 'supplement' ELSE '' END FROM events GROUP BY event_type
UNION ALL SELECT 'DATA_STORE=st_' || event_type FROM events WHERE event_type <> 'error' GROUP BY event_type
UNION ALL SELECT 'STORE_UUID=uuid-' || event_type FROM events GROUP BY event_type
UNION ALL SELECT any_value('END_STREAM') FROM events GROUP BY event_type) GROUP BY value""")
def _(spark, d):
    stream = receive.stream_lines(spark, inbox(spark, d)).select("value")
    return receive.collect_stream(spark, stream, "lines").groupBy("value").agg(F.count("*").alias("n"))


@query("stream_strip_control", f"SELECT value FROM ({EVENT_LINES})")
def _(spark, d):
    stream = receive.stream_strip_control(receive.stream_lines(spark, inbox(spark, d)))
    return receive.collect_stream(spark, stream.select("value"), "stripped")


@query("stream_parse_meta", """SELECT event_type || CASE WHEN event_type = 'signup' THEN 'supplement' ELSE '' END AS data_name,
 CASE WHEN event_type <> 'error' THEN 'st_' || event_type ELSE '' END AS store, 'uuid-' || event_type AS store_uuid, true AS ended FROM events GROUP BY event_type""")
def _(spark, d):
    lines = receive.collect_stream(spark, receive.stream_lines(spark, inbox(spark, d)), "meta")
    return receive.stream_parse_meta(lines).drop("folder").na.fill("", ["store"])


@query("stream_route", f"""SELECT CASE event_type WHEN 'error' THEN 'unrecognised' WHEN 'signup' THEN 'supplement' ELSE 'data' END AS route,
 CASE WHEN event_type = 'error' THEN 'error' ELSE '|uuids|uuid-' || event_type || '|uuide||kss|st_' || event_type || '|kse|' || event_type
 || CASE WHEN event_type = 'signup' THEN 'supplement' ELSE '' END END AS batch, value FROM ({EVENT_LINES})""")
def _(spark, d):
    out = new_folder(spark, "routed")
    receive.drain(receive.stream_route(receive.stream_lines(spark, inbox(spark, d)), out, new_folder(spark, "routed-state")))
    return spark.read.option("basePath", out).parquet(f"{out}/epoch=*").select("route", "batch", "value")


@once
def streamed(spark, d):
    """Order cells announced as batches by order status, ingested from a stream, with ledger and query."""
    frame = order_frame(spark, d)
    status = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("row_id"), F.concat(F.lit("st-"), "o_orderstatus").alias("batch_id"))
    parts = cell_parts(table(spark, d, "lineitem").count())
    dealt = status.repartition(parts, "row_id")
    # cells stay where they were dealt by row; only the rows, for their ids, are dealt beside them
    uid = uid_cells(frame.rows.repartition(parts, "row_id").join(dealt, "row_id"), "batch_id")
    drop = new_folder(spark, "drop")
    frame.cells.join(dealt, "row_id").unionByName(uid).select("batch_id", "row_id", "target", "term", "value").write.parquet(drop)
    store = S.Store(spark, new_folder(spark, "store"), "staging", S.StoreConfig(permitted_duplicates=0.9))
    book = new_folder(spark, "ledger")
    query_ = ingest.stream_ingest(ingest.stream_cells(spark, drop), store, STORE_UUID, book, new_folder(spark, "ingest-state"), now())
    receive.drain(query_)
    return store, book, query_


STAGED = """staged AS (SELECT row_id, lower(target) AS target, lower(regexp_replace(term, '[^A-Za-z0-9_-]', '', 'g')) AS term, value FROM
   (SELECT * FROM cells UNION ALL SELECT row_id, target, 'A_UID', CAST(row_id AS DOUBLE) + 1 FROM rws))"""


@query("stream_ingest", f"WITH {ORDERS}, {STAGED} SELECT s.*, 'st-' || o_orderstatus AS batch_id FROM staged s JOIN orders ON row_id = CAST(o_orderkey AS VARCHAR)")
def _(spark, d):
    store, _, _ = streamed(spark, d)
    frame = S.scan_store(store)
    return frame.cells.join(frame.rows.select("row_id", "batch_id"), "row_id")


@query("stream_ingest_ledger", "SELECT DISTINCT 'st-' || o_orderstatus AS batch_id, 'persisted' AS status, '' AS error_code FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def _(spark, d):
    _, book, _ = streamed(spark, d)
    return ledger.read_ledger(spark, book).select("batch_id", "status", "error_code")


def _read(micro):
    micro.write.format("noop").mode("overwrite").save()


@query("stream_metrics", """SELECT count(DISTINCT event_id % 105) AS completed, CAST(count(*) AS BIGINT) AS rows, CAST(1 AS BIGINT) AS failed, true AS delayed FROM events""")
def _(spark, d):
    """A query of over a hundred micro-batches, and one that fails at its first."""
    files, log = new_folder(spark, "parts"), new_folder(spark, "progress")
    events = table(spark, d, "events").select("event_id", "user_id", (F.col("event_id") % 105).alias("part"))
    events.repartition("part").write.partitionBy("part").parquet(files)
    listener = metrics.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for sink in (lambda micro, _: _read(micro), lambda micro, _: _read(micro.select(F.raise_error(F.lit("refused"))))):
            parts = spark.readStream.schema("event_id long, user_id long").option("maxFilesPerTrigger", 1).parquet(files)
            state = new_folder(spark, "metrics-state")
            run = parts.writeStream.foreachBatch(sink).option("checkpointLocation", state).trigger(availableNow=True).start()
            try:
                run.awaitTermination()
            except StreamingQueryException:
                pass  # the log must tell it
            listener.wait(run)
    finally:
        spark.streams.removeListener(listener)
    return metrics.stream_metrics(spark, log).select("completed", "rows", "failed", (F.col("mean_delay_ms") >= 0).alias("delayed"))


# --- the whole cycle -------------------------------------------------------------------------

LATE = "TIMESTAMP '2024-01-01 00:00:00'"


def announced_batches(spark, d):
    """Orders by status (those of one status for another store), documents as supplement, regions and nations announced longer than they are."""
    cells = order_frame_with_uid(spark, d).cells.select("row_id", "target", "term", "value")
    status = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("row_id"), F.concat(F.lit("st-"), "o_orderstatus").alias("batch_id"))
    recent, own = F.expr("TIMESTAMP '2024-01-31 23:00:00'"), F.lit(STORE_UUID)
    orders = cells.join(status, "row_id").withColumn("kind", F.lit("data")).withColumn("modified", recent)
    orders = orders.withColumn("batch_uuid", F.when(F.col("batch_id") == "st-P", "a uuid of another store").otherwise(own))
    texts = document_supplement(spark, d).select(
        "*", F.lit("sup-1").alias("batch_id"), F.lit("supplement").alias("kind"), recent.alias("modified"), own.alias("batch_uuid")
    )
    sizes = orders.groupBy("batch_id").agg(F.count("*").alias("announced")).unionByName(
        texts.groupBy("batch_id").agg(F.count("*").alias("announced"))
    )
    whole = orders.unionByName(texts, allowMissingColumns=True).join(F.broadcast(sizes), "batch_id")
    short = [
        table(spark, d, name).select(
            F.concat(F.lit(f"{name}-"), F.col(f"{name[0]}_{name}key").cast("string")).alias("row_id"), F.lit("t").alias("target"),
            F.col(f"{name[0]}_name").alias("term"), F.lit(1.0).alias("value"), F.lit(f"st-{name}").alias("batch_id"), F.lit("data").alias("kind"),
            modified.alias("modified"), own.alias("batch_uuid"), F.lit(10**9).alias("announced"),
        )
        for name, modified in (("region", F.expr(LATE)), ("nation", recent))
    ]
    for part in short:
        whole = whole.unionByName(part, allowMissingColumns=True)
    fields = [f.split()[0] for f in ingest.CYCLE_SCHEMA.split(", ")]
    return whole.select(*fields)


def run_whole_cycle(spark, drop, max_files=None):
    config = S.StoreConfig(flush=True, trim=False, flush_threshold=0, archive=True)
    root, state = new_folder(spark, "cycle"), new_folder(spark, "cycle-state")
    cycle = ingest.Cycle(
        S.Store(spark, root, "staging", config), S.Store(spark, root, "final"), STORE_UUID, f"{root}/ledger", f"{root}/landed", f"{root}/done", 86_400_000
    )
    receive.drain(ingest.stream_cycle(ingest.stream_cells(spark, drop, max_files, ingest.CYCLE_SCHEMA), cycle, state, now()))
    return cycle


@once
def cycled(spark, d):
    drop = new_folder(spark, "announced")
    announced_batches(spark, d).write.parquet(drop)
    return run_whole_cycle(spark, drop)


@query("ingest_cycle", f"""WITH {ORDERS}, {STAGED} SELECT s.*, count(*) OVER () AS n_cells FROM staged s JOIN orders ON row_id = CAST(o_orderkey AS VARCHAR)
WHERE o_orderstatus <> 'P' AND term <> 'a_uid'""")
def _(spark, d):
    cells = S.scan_store(cycled(spark, d).final).cells
    return cells.withColumn("n_cells", cells.agg(F.count("*")).scalar())


@query("ingest_cycle_supplement", "SELECT CAST(doc_id AS VARCHAR) AS uuid, source AS aa_label, md5(text) AS text_md5 FROM documents")
def _(spark, d):
    return S.scan_supplement(cycled(spark, d).final).select("uuid", "aa_label", F.md5("rawsentence").alias("text_md5"))


CYCLE_BATCHES = """batches AS (SELECT DISTINCT 'st-' || o_orderstatus AS batch_id, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'promoted' END AS status,
   CASE WHEN o_orderstatus = 'P' THEN 'Thebatchisforanother' ELSE '' END AS error_code FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  UNION SELECT 'sup-1', 'promoted', '' FROM documents UNION SELECT 'st-region', 'late', '' FROM region)"""


@query("ingest_cycle_status", f"""WITH {CYCLE_BATCHES} SELECT * FROM batches UNION SELECT 'st-nation', 'arrived', '' FROM nation
UNION SELECT 'promotion-0', 'persisted', '' FROM orders""")
def _(spark, d):
    return ledger.latest_status(ledger.read_ledger(spark, cycled(spark, d).ledger_path))


@query("batch_folders", f"""WITH {CYCLE_BATCHES} SELECT CASE status WHEN 'failed' THEN 'failed/' || error_code WHEN 'late' THEN 'late' ELSE 'persisted' END AS place, batch_id FROM batches""")
def _(spark, d):
    """Where the folders of processed batches were moved to, as the file source lists them."""
    files = list_files(spark, cycled(spark, d).done)
    at = F.regexp_extract("path", r"/done/(.*)/batch_id=([^/]*)/", 1).alias("place")
    return files.select(at, F.regexp_extract("path", r"/done/(.*)/batch_id=([^/]*)/", 2).alias("batch_id")).distinct()


PROMOTED = f"""{ORDERS}, {STAGED}, sums AS (SELECT term, sum(value) AS total FROM staged GROUP BY term), {median_cut('m', 'sums', 'total')},
  moved AS (SELECT * FROM staged WHERE term <> 'a_uid' AND term NOT IN (SELECT term FROM sums, m WHERE total < cut))"""


def _staging(spark, d, threshold):
    from workload.fixtures import copy_of

    store = copy_of(streamed(spark, d)[0])
    return S.Store(spark, store.root, store.name, S.StoreConfig(flush=True, flush_threshold=threshold))


def _promoted(spark, d, promote, threshold):
    staging = _staging(spark, d, threshold)
    final = S.Store(spark, staging.root, "final")
    status = promote(staging, final, STORE_UUID, new_folder(spark, "ledger"), "promotion-1", F.expr("TIMESTAMP '2024-02-02 00:00:00'"))
    left = S.scan(staging, "data").count()
    cells = S.scan_store(final).cells
    return cells.withColumn("status", F.lit(status)).withColumn("left_in_staging", F.lit(left).cast("bigint"))


@query("promote_staging", f"WITH {PROMOTED} SELECT row_id, target, term, value, 'promoted' AS status, CAST(0 AS BIGINT) AS left_in_staging FROM moved")
def _(spark, d):
    return _promoted(spark, d, ingest.promote_staging, 500)


@query("promote_aged", f"WITH {PROMOTED} SELECT row_id, target, term, value, 'promoted' AS status, CAST(0 AS BIGINT) AS left_in_staging FROM moved")
def _(spark, d):
    return _promoted(spark, d, ingest.promote_aged, 10**9)


@query("promote_check", """SELECT event_type, count(*) AS n_rows, epoch_ms(max(ts)) < epoch_ms(TIMESTAMP '2024-01-31 11:30:00') - 12 * 3600000 AS due FROM events GROUP BY event_type""")
def _(spark, d):
    cut = F.expr("TIMESTAMP '2024-01-31 11:30:00'")
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kinds = [r["event_type"] for r in events.select("event_type").distinct().collect()]
    parts = [ingest.is_aged(events.where(F.col("event_type") == k), cut).select(F.lit(k).alias("event_type"), "n_rows", "due") for k in kinds]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- runs of steps --------------------------------------------------------------------------

SUMS = "sums AS (SELECT term, sum(value) AS total FROM cells GROUP BY term)"


@query("run_steps", f"""WITH {DOCS}, {SUMS}, {median_cut('m', 'sums', 'total')},
 kept AS (SELECT * FROM cells WHERE term NOT IN (SELECT term FROM sums, m WHERE total < cut + 2)),
 tf AS (SELECT row_id, target, term, value / sum(value) OVER (PARTITION BY row_id) AS value FROM kept),
 idf AS (SELECT term, ln((SELECT CAST(count(*) AS DOUBLE) FROM rws) / count(*)) AS w FROM kept GROUP BY term)
SELECT row_id, target, tf.term, round(tf.value * w, 6) AS value FROM tf JOIN idf ON tf.term = idf.term""")
def _(spark, d):
    run = [lambda f: C.remove_low_frequency(f, 2.0), X.tfidf]
    return cells_out(steps.run_steps(document_frame(spark, d).materialise(), run))


@query("run_steps_by_target", f"""WITH {ORDERS}, sums AS (SELECT target, term, sum(value) AS total FROM cells GROUP BY ALL), {median_cut('m', 'sums', 'total', 'target')},
 low AS (SELECT sums.target, term FROM sums JOIN m ON sums.target = m.target WHERE total < cut),
 kept AS (SELECT * FROM cells WHERE (target, term) NOT IN (SELECT target, term FROM low)),
 tf AS (SELECT row_id, target, term, value / sum(value) OVER (PARTITION BY row_id) AS value FROM kept),
 per AS (SELECT target, CAST(count(*) AS DOUBLE) AS n FROM rws GROUP BY target),
 idf AS (SELECT k.target, term, ln(any_value(n) / count(*)) AS w FROM kept k JOIN per ON k.target = per.target GROUP BY ALL)
SELECT row_id, tf.target, tf.term, round(tf.value * w, 6) AS value FROM tf JOIN idf ON tf.term = idf.term AND tf.target = idf.target""")
def _(spark, d):
    frame = order_frame(spark, d).materialise()
    return cells_out(steps.run_by_target(frame, [C.remove_low_frequency, X.tfidf]))


@query("empty_dataset", f"WITH {ORDERS} SELECT row_id, target, term, value FROM cells")
def _(spark, d):
    return empty_frame(spark).cells.unionByName(order_frame(spark, d).cells)


SHARES = "shares AS (SELECT term, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM rws) AS proportion FROM cells GROUP BY term)"


def _hashes_of(cells: str) -> str:
    return f"""bodies AS (SELECT row_id, string_agg(term || ':' || CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR), ' ' ORDER BY term) AS body FROM {cells} GROUP BY row_id),
  first AS (SELECT min(r.row_id) AS row_id FROM rws r LEFT JOIN bodies b ON r.row_id = b.row_id GROUP BY r.target, coalesce(b.body, ''))"""


HIGH = f"""{SHARES}, {legacy_cut('hp', 'shares', 'proportion', 99)},
  c1 AS (SELECT * FROM cells WHERE term NOT IN (SELECT term FROM shares, hp WHERE proportion > cut))"""
FINAL_TFIDF = """tf AS (SELECT row_id, target, term, value / sum(value) OVER (PARTITION BY row_id) AS value FROM final),
  per AS (SELECT target, CAST(count(*) AS DOUBLE) AS n FROM rws WHERE row_id IN (SELECT row_id FROM first) GROUP BY target),
  idf AS (SELECT f.target, term, ln(any_value(n) / count(*)) AS w FROM final f JOIN per ON f.target = per.target GROUP BY ALL)
  SELECT 'counts' AS stage, row_id, target, term, value FROM final UNION ALL
  SELECT 'tfidf', row_id, tf.target, tf.term, round(tf.value * w, 6) FROM tf JOIN idf ON tf.term = idf.term AND tf.target = idf.target"""


def _stages(out):
    counts = cells_out(out["counts"]).select(F.lit("counts").alias("stage"), "*")
    return counts.unionByName(cells_out(out["tfidf"]).select(F.lit("tfidf").alias("stage"), "*"))


@query("preset_documents", f"""WITH {LANG}, {HIGH}, s1 AS (SELECT term, sum(value) AS total FROM c1 GROUP BY term), {legacy_cut('lp', 's1', 'total', 75)},
 n AS (SELECT target FROM rws GROUP BY target HAVING count(*) >= 110),
 c2 AS (SELECT * FROM c1 WHERE term NOT IN (SELECT term FROM s1, lp WHERE total < cut) AND target IN (SELECT target FROM n)),
 {_hashes_of('c2').replace('FROM rws r', 'FROM (SELECT * FROM rws WHERE target IN (SELECT target FROM n)) r')},
 final AS (SELECT * FROM c2 WHERE row_id IN (SELECT row_id FROM first)), {FINAL_TFIDF}""")
def _(spark, d):
    return _stages(presets.documents(document_frame(spark, d, "lang"), min_rows=110))


@query("preset_posts", f"""WITH {DOCS}, {HIGH}, {_hashes_of('c1')}, final AS (SELECT * FROM c1 WHERE row_id IN (SELECT row_id FROM first)), {FINAL_TFIDF}""")
def _(spark, d):
    return _stages(presets.posts(document_frame(spark, d)))


def merge_map(spark):
    return spark.createDataFrame([("NOT_SPECIFIED", "LOW"), ("URGENT", "HIGH")], "old string, new string")


@query("preset_sentences", f"""WITH {ORDERS.replace('rws AS', 'rws0 AS').replace('cells AS', 'cells0 AS')},
 lab AS (SELECT row_id, {HASH_LABELS} AS target, term, value FROM cells0), rws AS (SELECT row_id, {MERGED} AS target FROM (SELECT row_id, {HASH_LABELS} AS target FROM rws0)),
 cells AS (SELECT row_id, {MERGED} AS target, term, value FROM lab), {HIGH}, n AS (SELECT target FROM rws GROUP BY target HAVING count(*) >= 1500),
 c2 AS (SELECT * FROM c1 WHERE target IN (SELECT target FROM n)),
 {_hashes_of('c2').replace('FROM rws r', 'FROM (SELECT * FROM rws WHERE target IN (SELECT target FROM n)) r')},
 final AS (SELECT * FROM c2 WHERE row_id IN (SELECT row_id FROM first)), {FINAL_TFIDF}""")
def _(spark, d):
    return _stages(presets.sentences(hash_labels(order_frame(spark, d)), merge_map(spark)))


@query("preset_trim_only", f"WITH {LANG} SELECT {CELLS_OUT} FROM cells WHERE target IN (SELECT target FROM rws GROUP BY target HAVING count(*) >= 120)")
def _(spark, d):
    return cells_out(presets.trim_only(document_frame(spark, d, "lang"), 120)["by_label"])


@query("preset_supplement_output", "SELECT lang AS label, CAST(doc_id AS VARCHAR) AS uuid FROM documents")
def _(spark, d):
    docs = table(spark, d, "documents")
    supplement = docs.select(F.col("doc_id").cast("string").alias("uuid"), F.concat("lang", F.lit(" "), "source").alias("aa_label"))
    labels = docs.select(F.concat(F.lit("#"), "lang").alias("target")).distinct()
    return presets.supplement_output(supplement, labels).select("label", "uuid")


@query("preset_phrase_coding", f"WITH {CODED} SELECT uuid, CAST(label_id AS VARCHAR) AS aa_label, CASE WHEN long THEN '1' ELSE '0' END AS longtext FROM good")
def _(spark, d):
    store = S.Store(spark, new_folder(spark, "codes"), presets.CODES_STORE)
    presets.phrase_coding(read_header_csv(spark, coded_csv(spark, d)), ["longtext", "user"], store, "b1", now())
    return S.scan_supplement(store).select("uuid", "aa_label", "longtext")


SMALL = CycleSettings(k=3, iterations=4, init_steps=2, top_terms=4, spread=2)


def _phrases(out):
    return out["phrases"].select(F.lit("all").alias("part"), "row_id", "cluster", "term1", "term2", "label").unionByName(
        out["phrases_by_target"].select(F.lit("label").alias("part"), "row_id", "cluster", "term1", "term2", "label")
    )


@query("preset_phrases_kmeans")
def _(spark, d):
    return _phrases(presets.phrases_kmeans(order_frame(spark, d), merge_map(spark), order_supplement(spark, d), SMALL, min_rows=100))


@query("preset_phrases_lda")
def _(spark, d):
    return _phrases(presets.phrases_lda(order_frame(spark, d), merge_map(spark), order_supplement(spark, d), SMALL, min_rows=100))


@query("store_steps", f"WITH {STORE_CELLS} SELECT row_id, target, term, value FROM stored")
def _(spark, d):
    """Create, overwrite and save as steps of one run, over all orders."""
    store = S.Store(spark, new_folder(spark, "store"), "steps")

    def create(frame: SparseFrame) -> SparseFrame:
        S.create_store(store, STORE_UUID)
        return frame

    def overwrite(frame: SparseFrame) -> SparseFrame:
        S.overwrite_store(store, STORE_UUID)
        return frame

    def save(frame: SparseFrame) -> SparseFrame:
        S.append_batch(store, frame, "b1", now())
        return S.scan_store(store)

    return steps.run_steps(order_frame_with_uid(spark, d), [create, overwrite, save]).cells

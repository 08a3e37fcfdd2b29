"""Queries on sources, sinks and the store."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from termloom.frame import SparseFrame, document_frame, number_targets, number_terms, order_frame, table
from termloom.operators.rows import row_hashes
from termloom.operators.targets import count_by_target
from termloom.scratch import new_folder
from termloom.sources import batches as B
from termloom.sources import cache, ledger
from termloom.sources import store as S
from termloom.sources import tables as T
from termloom.sources import triplet as L
from termloom.streaming.ingest import ingest_batch
from workload.fixtures import (
    CLUSTERS,
    NOW,
    STORE_UUID,
    by_status,
    cluster_report,
    copy_of,
    document_supplement,
    now,
    once,
    order_frame_with_uid,
    order_store,
)
from workload.registry import DOCS, HASHES, ORDERS, doc_ctes, query

CELLS = f"WITH {ORDERS} SELECT row_id, target, term, value FROM cells"
LANG = doc_ctes("lang")

# --- triplets ---------------------------------------------------------------


@once
def order_triplet(spark, d):
    """The order frame as files, with unreadable lines among the data."""
    folder = new_folder(spark, "triplet")
    paths = L.write_libsvm_triplet(order_frame_with_uid(spark, d), folder, "orders|1")
    noise = table(spark, d, "events").select(F.concat_ws(" ", "event_type", "props"))
    noise.write.mode("append").text(paths["data"])
    return paths


@query("read_libsvm_rejects", "SELECT event_type || ' ' || props AS line, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    paths = order_triplet(spark, d)
    parsed = L.read_libsvm_triplet(spark, paths["data"], paths["columnMap"], paths["targetMap"])
    return parsed.rejects.groupBy("line").agg(F.count("*").alias("n"))


UID_CELLS = "allcells AS (SELECT term FROM cells UNION ALL SELECT 'A_UID')"
NUMBER_T = "SELECT term, CAST(row_number() OVER (ORDER BY md5(term), term) AS INTEGER) AS idx FROM (SELECT DISTINCT term FROM {0})"
NUMBER_L = "SELECT target, CAST(row_number() OVER (ORDER BY md5(target), target) AS DOUBLE) AS idx FROM (SELECT DISTINCT target FROM rws)"


@query("read_column_map", f"WITH {ORDERS}, {UID_CELLS} {NUMBER_T.format('allcells')}")
def _(spark, d):
    return L.read_column_map(spark, order_triplet(spark, d)["columnMap"])


@query("read_target_map", f"WITH {ORDERS} {NUMBER_L}")
def _(spark, d):
    return L.read_target_map(spark, order_triplet(spark, d)["targetMap"])


@query("write_libsvm_triplet", f"""WITH {ORDERS}, t AS ({NUMBER_T.format('cells')}), l AS ({NUMBER_L}),
b AS (SELECT c.row_id, c.target, string_agg(t.idx || ':' || CAST(c.value AS BIGINT), ' ' ORDER BY t.idx) AS body
      FROM cells c JOIN t ON c.term = t.term GROUP BY ALL)
SELECT CAST(l.idx AS BIGINT) || ' ' || body AS line FROM b JOIN l ON b.target = l.target""")
def _(spark, d):
    paths = L.write_libsvm_triplet(order_frame(spark, d), new_folder(spark, "triplet"), "orders")
    return spark.read.text(paths["data"]).withColumnRenamed("value", "line")


@query("merge_sparse_batches", CELLS)
def _(spark, d):
    """Two overlapping sets with their own numbering, written, read and merged by name."""
    whole = order_frame_with_uid(spark, d).materialise()
    frames = []
    for name, finished in (("fin", True), ("open", False)):
        part = by_status(spark, d, whole, finished)
        extra = by_status(spark, d, whole, not finished)
        shared = SparseFrame(
            part.rows.unionByName(extra.rows.where("target = '5-LOW'")),
            part.cells.unionByName(extra.cells.where("target = '5-LOW'")),
        )
        paths = L.write_libsvm_triplet(shared, new_folder(spark, "triplet"), name)
        parsed = L.read_libsvm_triplet(spark, paths["data"], paths["columnMap"], paths["targetMap"])
        frames.append(L.to_frame(parsed, "A_UID"))
    return _shift(L.merge_sparse_batches(frames))


def _shift(frame):
    """The uid of the triplets is the order key + 1."""
    return frame.cells.withColumn("row_id", (F.col("row_id").cast("long") - 1).cast("string"))


@query("read_libsvm_triplet", CELLS)
def _(spark, d):
    paths = order_triplet(spark, d)
    parsed = L.read_libsvm_triplet(spark, paths["data"], paths["columnMap"], paths["targetMap"])
    return _shift(L.to_frame(parsed, "A_UID"))


@query("tokenize_documents", f"WITH {DOCS} SELECT row_id, term, value FROM cells")
def _(spark, d):
    return document_frame(spark, d).cells.select("row_id", "term", "value")


# --- CSV and text files -------------------------------------------------------


def _as_csv(df, spark, label):
    """Write as CSV the way a well-behaved producer does, and return the path."""
    path = new_folder(spark, label)
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


@query("read_supplement_csv", "SELECT CAST(doc_id AS VARCHAR) AS uuid, source AS aa_label, md5(text) AS text_md5 FROM documents")
def _(spark, d):
    raw = T.read_supplement_csv(spark, _as_csv(document_supplement(spark, d), spark, "csv"))
    return raw.select("uuid", "aa_label", F.md5("rawsentence").alias("text_md5"))


@query("read_cluster_terms", f"""WITH {ORDERS}, {CLUSTERS}, k AS (SELECT term, CAST(row_number() OVER (ORDER BY md5(term), term) AS INTEGER) AS term_id
  FROM (SELECT DISTINCT term FROM cells)), l AS (SELECT target, CAST(row_number() OVER (ORDER BY md5(target), target) AS DOUBLE) AS target_id
  FROM (SELECT DISTINCT target FROM rws))
SELECT report.target, iteration, cluster, report.term, value, term_id, target_id FROM report JOIN k ON report.term = k.term
LEFT JOIN l ON report.target = l.target WHERE report.term <> 'Brand#1'""")
def _(spark, d):
    frame = order_frame(spark, d)
    report = cluster_report(spark, d).select(
        F.lit(0).alias("row_no"), "*", F.lit("kmeans").alias("analysis_type")
    )
    path = new_folder(spark, "clusters")
    T.write_cluster_terms(report, path)
    known = number_terms(frame.cells).where("term <> 'Brand#1'")
    out = T.read_cluster_terms(T.read_header_csv(spark, path), known, number_targets(frame.rows))
    return out.select("target", "iteration", "cluster", "term", "value", "term_id", "target_id")


@query("write_cluster_terms", f"WITH {CLUSTERS} SELECT target, term, CAST(2 * count(*) AS BIGINT) AS n, sum(value) * 2 AS value FROM report GROUP BY ALL")
def _(spark, d):
    report = cluster_report(spark, d).select(F.lit(0).alias("row_no"), "*", F.lit("lda").alias("analysis_type"))
    path = new_folder(spark, "clusters")
    T.write_cluster_terms(report, path, "overwrite")
    T.write_cluster_terms(report, path, "append")
    back = T.read_header_csv(spark, path).groupBy(F.col("Target").alias("target"), F.col("Term").alias("term"))
    return back.agg(F.count("*").alias("n"), F.sum(F.col("Value").cast("double")).alias("value"))


@once
def coded_csv(spark, d):
    turns = table(spark, d, "conversations")
    words = F.array_join(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0)), " ")
    coded = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("uid"),
        words.alias("lemmatizedPhrase"),
        F.col("role").alias("CODE_role"),
        F.when(F.length("text") > 200, "Long Text!").alias("CODE_length"),
        F.when(F.col("turn") == 0, F.col("role")).alias("CODE_first"),
        F.col("turn").alias("targetId"),
        F.concat(F.lit("turn "), F.col("turn")).alias("targetName"),
    )
    return _as_csv(coded, spark, "coded")


CODED = """coded AS (SELECT conv_id || '-' || turn AS uuid, CAST(turn AS INTEGER) AS label_id, 'turn ' || turn AS label_name,
   regexp_extract_all(lower(text), '[a-z]{3,}') AS lemmas, role, length(text) > 200 AS long FROM conversations),
  good AS (SELECT * FROM coded WHERE len(lemmas) > 0)"""


@query("read_coded_sentences", f"""WITH {CODED} SELECT uuid, label_id, label_name, CAST(len(lemmas) AS INTEGER) AS n_words,
 CASE WHEN long THEN 'Long Text!,' ELSE '' END || role AS codes FROM good""")
def _(spark, d):
    good, _ = T.read_coded_sentences(T.read_header_csv(spark, coded_csv(spark, d)))
    return good.select("uuid", "label_id", "label_name", F.size("lemmas").alias("n_words"), F.array_join("codes", ",").alias("codes"))


@query("write_coded_sentences", f"""WITH {CODED} SELECT uuid, label_id, label_name, array_to_string(lemmas, ', ') AS bagofwords,
 CASE WHEN long THEN 1 ELSE 0 END AS longtext, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS "user",
 CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS assistant FROM good""")
def _(spark, d):
    good, _ = T.read_coded_sentences(T.read_header_csv(spark, coded_csv(spark, d)))
    return T.pivot_codes(good, ["longtext", "user", "assistant"])


@query("training_set_from_codes", f"""WITH {CODED}, c AS (SELECT *, role AS code FROM good UNION ALL SELECT *, 'Long Text!' FROM good WHERE long)
SELECT uuid || '_' || code AS row_id, code AS target, unnest(list_distinct(lemmas)) AS term, CAST(1 AS DOUBLE) AS value FROM c
UNION ALL SELECT uuid || '_' || code, code, 'MajorCode', CAST(label_id AS DOUBLE) FROM c""")
def _(spark, d):
    good, _ = T.read_coded_sentences(T.read_header_csv(spark, coded_csv(spark, d)))
    return T.training_set_from_codes(good)


@query("read_item_properties", """WITH last AS (SELECT p_partkey % 7 + 1 AS id, p_type AS property, arg_max(p_name, p_partkey) AS value,
 arg_max(p_brand, p_partkey) AS prompt, arg_max(CAST(p_size AS VARCHAR), p_partkey) AS stem FROM part GROUP BY ALL)
SELECT id, max(prompt) AS prompt, max(stem) AS stem, string_agg(property || '=' || value, ';' ORDER BY property) AS properties FROM last GROUP BY id""")
def _(spark, d):
    long = table(spark, d, "part").select(
        (F.col("p_partkey") % 7 + 1).alias("id"),
        F.col("p_brand").alias("prompt"),
        F.col("p_size").cast("string").alias("stem"),
        F.col("p_type").alias("property"),
        F.col("p_name").alias("value"),
        F.col("p_partkey").alias("seq"),
    )
    items = T.read_item_properties(long)
    pairs = F.transform(F.map_entries("properties"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return items.select("id", "prompt", "stem", F.array_join(F.array_sort(pairs), ";").alias("properties"))


@query("read_item_options", "SELECT p_type AS option_id, arg_max(p_brand, p_partkey) AS code FROM part GROUP BY p_type")
def _(spark, d):
    raw = table(spark, d, "part").select(F.col("p_type").alias("option_id"), F.col("p_brand").alias("code"), F.col("p_partkey").alias("seq"))
    back = T.read_header_csv(spark, _as_csv(raw, spark, "options"))
    return T.read_item_options(back.withColumn("seq", F.col("seq").cast("long")))


@query("read_header_text", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return T.read_header_text(spark.read.text(_as_csv(orders.repartition(4), spark, "header")))


@query("read_merge_map", "SELECT n_name AS old, r_name || '=X' AS new FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    nation = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    lines = nation.select(F.concat("n_name", F.lit(" = "), "r_name", F.lit("=X")).alias("value")).union(
        nation.select(F.concat(F.lit("# "), "n_name", F.lit("=none")))
    ).union(nation.select("n_name"))
    path = new_folder(spark, "merge")
    lines.write.text(path)
    return T.read_merge_map(spark, path)


# --- batch folders ---------------------------------------------------------------

PATHS = """paths AS (SELECT event_id, ts AS modified, CASE WHEN event_type = 'error' THEN '/in/failed/' ELSE '/in/' END ||
  '|uuids|user-' || user_id || '|uuide||kss|' || event_type || '|kse|set' || (user_id % 3) AS folder FROM events)"""


def _listing(spark, d):
    kind = F.when(F.col("event_type") == "error", "/in/failed/").otherwise("/in/")
    folder = F.concat(
        kind, F.lit("|uuids|user-"), "user_id", F.lit("|uuide||kss|"), "event_type", F.lit("|kse|set"),
        (F.col("user_id") % 3).cast("string"),
    )
    return table(spark, d, "events").select(
        "event_id", F.concat(folder, F.lit("/part-"), "event_id").alias("path"), F.col("ts").alias("modified")
    )


@query("discover_batches", f"""WITH {PATHS} SELECT folder, count(*) AS n_files, regexp_extract(folder, '\\|kss\\|(.*?)\\|kse\\|', 1) AS store,
 regexp_extract(folder, '\\|uuids\\|(.*?)\\|uuide\\|', 1) AS batch_uuid FROM paths WHERE NOT contains(folder, 'failed') GROUP BY folder
HAVING epoch_ms(TIMESTAMP '2024-01-31 00:00:00') - epoch_ms(max(modified)) > 172800000""")
def _(spark, d):
    return B.discover_batches(_listing(spark, d), F.expr("TIMESTAMP '2024-01-31 00:00:00'"), 172_800_000)


@query("batch_key_from_path", f"""WITH {PATHS} SELECT event_id, regexp_extract(folder, '\\|kss\\|(.*?)\\|kse\\|', 1) AS store,
 regexp_extract(folder, '\\|uuids\\|(.*?)\\|uuide\\|', 1) AS batch_uuid FROM paths""")
def _(spark, d):
    path = F.col("path")
    return _listing(spark, d).select("event_id", B.store_of(path).alias("store"), B.uuid_of(path).alias("batch_uuid"))


@query("compile_row_blocks", """SELECT o_orderkey AS uid, o_orderstatus AS status, o_orderpriority AS priority, coalesce(n, 0) AS n_lines
FROM (SELECT o_orderkey FROM orders UNION SELECT l_orderkey FROM lineitem) k LEFT JOIN orders USING (o_orderkey)
LEFT JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l USING (o_orderkey)""")
def _(spark, d):
    orders = table(spark, d, "orders")
    first = orders.select(F.col("o_orderkey").alias("uid"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("junk"))
    second = orders.select(F.col("o_orderkey").alias("uid"), F.col("o_orderpriority").alias("priority"), F.lit(2).alias("junk"))
    third = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("uid")).agg(F.count("*").alias("n_lines"))
    return T.compile_row_blocks([first, second, third], "uid", ["junk"]).na.fill(0, ["n_lines"])


# --- the store -----------------------------------------------------------------------

STORE_CELLS = f"""{ORDERS}, raw AS (SELECT row_id, lower(target) AS target, lower(regexp_replace(term, '[^A-Za-z0-9_-]', '', 'g')) AS term, value
   FROM (SELECT * FROM cells UNION ALL SELECT row_id, target, 'A_UID', CAST(row_id AS DOUBLE) + 1 FROM rws)),
  stored AS (SELECT raw.*, CASE WHEN o_orderstatus = 'F' THEN 'batch-f' ELSE 'batch-op' END AS batch_id
   FROM raw JOIN orders ON raw.row_id = CAST(o_orderkey AS VARCHAR))"""


def _dictionary(key: str, kind: str) -> str:
    """SQL for a dictionary numbered batch by batch."""
    return f"""first AS (SELECT {key}, min(batch_id) AS batch_id FROM stored GROUP BY {key}),
  dict AS (SELECT {key}, batch_id, CAST(row_number() OVER (ORDER BY batch_id, md5({key}), {key}) AS {kind}) AS idx FROM first)"""


@query("scan_store", f"WITH {STORE_CELLS} SELECT row_id, target, term, value FROM stored")
def _(spark, d):
    return S.scan_store(order_store(spark, d)).cells


@query("scan_store_where", f"""WITH {STORE_CELLS} SELECT row_id, batch_id FROM stored WHERE term IN ('brand1', 'brand2') AND target = '1-urgent'
GROUP BY ALL HAVING count(*) = 2""")
def _(spark, d):
    return S.scan_store_where(order_store(spark, d), ["brand1", "brand2"], "1-urgent").select("row_id", "batch_id")


@query("scan_store_schema", f"""WITH {STORE_CELLS} SELECT 'column' AS kind, term AS name FROM stored GROUP BY term
UNION ALL SELECT 'target', target FROM stored GROUP BY target""")
def _(spark, d):
    columns, targets = S.scan_schema(order_store(spark, d))
    return columns.select(F.lit("column").alias("kind"), F.col("term").alias("name")).union(
        targets.select(F.lit("target"), "target")
    )


@query("scan_columns", f"WITH {STORE_CELLS}, {_dictionary('term', 'INTEGER')} SELECT term, idx FROM dict")
def _(spark, d):
    return S.scan_columns(order_store(spark, d))


@query("scan_targets", f"WITH {STORE_CELLS}, {_dictionary('target', 'DOUBLE')} SELECT target, idx FROM dict")
def _(spark, d):
    return S.scan_targets(order_store(spark, d))


@query("scan_id_map", f"WITH {ORDERS} SELECT DISTINCT CAST(row_id AS DOUBLE) + 1 AS old_id, row_id FROM rws")
def _(spark, d):
    return S.scan_id_map(order_store(spark, d))


@query("append_id_map", f"""WITH {STORE_CELLS} SELECT DISTINCT CAST(row_id AS DOUBLE) + 1 AS old_id, row_id, batch_id FROM stored""")
def _(spark, d):
    store = order_store(spark, d)
    place = S.scan_columns(store).where("term = 'a_uid'").agg(F.min("idx").alias("i")).scalar()
    return S.id_map_rows(S.scan(store, "data"), place).select("old_id", "row_id", "batch_id")


@query("scan_store_dataframe", f"""WITH {STORE_CELLS}, b AS (SELECT row_id, target, batch_id, count(*) AS n_cells,
 string_agg(term || ':' || CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR), ' ' ORDER BY term) AS body FROM stored GROUP BY row_id, target, batch_id)
SELECT row_id, target, batch_id, CAST(n_cells AS INTEGER) AS n_cells, md5(target || '|' || body) AS row_hash FROM b""")
def _(spark, d):
    return S.scan_dataframe(order_store(spark, d)).select("row_id", "target", "batch_id", F.size("indices").alias("n_cells"), "row_hash")


@query("append_store", f"WITH {STORE_CELLS} SELECT batch_id, count(DISTINCT row_id) AS n_rows, count(*) AS n_cells, sum(value) AS total FROM stored GROUP BY batch_id")
def _(spark, d):
    data = S.scan(order_store(spark, d), "data")
    sums = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    return data.groupBy("batch_id").agg(
        F.count("*").alias("n_rows"), F.sum(F.size("indices")).alias("n_cells"), F.sum(sums).alias("total")
    )


@query("append_inverted_index", f"WITH {STORE_CELLS} SELECT term, row_id, batch_id FROM stored")
def _(spark, d):
    return S.scan(order_store(spark, d), "index").select("term", "row_id", "batch_id")


@query("scan_supplement", "SELECT CAST(doc_id AS VARCHAR) AS uuid, source AS aa_label, md5(text) AS text_md5 FROM documents")
def _(spark, d):
    return S.scan_supplement(order_store(spark, d)).select("uuid", "aa_label", F.md5("rawsentence").alias("text_md5"))


@query("append_supplement", """SELECT CAST(o_orderkey AS VARCHAR) AS uuid, nullif(o_orderstatus, 'P') AS aa_label, o_orderpriority AS orderpriority
FROM orders WHERE o_orderstatus <> 'P'""")
def _(spark, d):
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("UUID"),
        F.expr("nullif(o_orderstatus, 'P')").alias("aa_label"),
        F.col("o_orderpriority").alias("Order Priority?"),
    )
    store = S.Store(spark, new_folder(spark, "store"), "supplement")
    S.create_supplement(store, raw)
    S.append_supplement(store, raw, "b1", now())
    return S.scan_supplement(store).select("uuid", "aa_label", "orderpriority")


NEW_WORDS = f"""known AS (SELECT term, row_number() OVER (ORDER BY md5(term), term) AS idx FROM (SELECT DISTINCT term FROM cells WHERE target = 'fr')),
  unseen AS (SELECT DISTINCT term FROM cells WHERE target = 'en' AND term NOT IN (SELECT term FROM known))"""


def _vocabularies(spark, d):
    cells = document_frame(spark, d, "lang").cells
    return cells.where("target = 'en'"), number_terms(cells.where("target = 'fr'"))


@query("append_columns", f"""WITH {LANG}, {NEW_WORDS}
SELECT term, CAST((SELECT max(idx) FROM known) + row_number() OVER (ORDER BY md5(term), term) AS INTEGER) AS idx FROM unseen""")
def _(spark, d):
    incoming, known = _vocabularies(spark, d)
    return S.append_dictionary(incoming, known, "term", "int")


@query("append_targets", """WITH known AS (SELECT source AS target, row_number() OVER (ORDER BY md5(source), source) AS idx FROM
 (SELECT DISTINCT source FROM documents WHERE lang = 'es')), unseen AS (SELECT DISTINCT lower(o_orderpriority) AS target FROM orders)
SELECT target, CAST((SELECT max(idx) FROM known) + row_number() OVER (ORDER BY md5(target), target) AS DOUBLE) AS idx FROM unseen""")
def _(spark, d):
    known = number_targets(table(spark, d, "documents").where("lang = 'es'").select(F.col("source").alias("target")))
    incoming = table(spark, d, "orders").select(F.col("o_orderpriority").alias("target"))
    return S.append_dictionary(incoming, known, "target", "double")


@query("new_terms", f"WITH {LANG}, {NEW_WORDS} SELECT term FROM unseen")
def _(spark, d):
    incoming, known = _vocabularies(spark, d)
    return S.new_terms(incoming, known)


@query("new_targets", "SELECT DISTINCT lower(o_orderpriority) AS target FROM orders WHERE o_orderpriority <> '5-LOW'")
def _(spark, d):
    labels = table(spark, d, "orders").select(F.col("o_orderpriority").alias("target"))
    return S.new_terms(labels, labels.where("target = '5-LOW'").distinct(), "target")


@query("replace_columns", f"WITH {DOCS} {NUMBER_T.format('cells')}")
def _(spark, d):
    store = copy_of(order_store(spark, d))
    S.replace_columns(store, number_terms(document_frame(spark, d).cells), "b9")
    return S.scan_columns(store)


@query("evolve_schema", """SELECT CAST(doc_id AS VARCHAR) AS uuid, source AS aa_label, CAST(NULL AS VARCHAR) AS quality FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, CAST(quality AS VARCHAR) FROM labels""")
def _(spark, d):
    known = document_supplement(spark, d).drop("rawsentence")
    incoming = table(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("uuid"), F.col("quality").cast("string").alias("quality")
    )
    return S.evolve_schema(known, incoming)


@query("create_store", f"""WITH {STORE_CELLS} SELECT 'data' AS "table", count(DISTINCT row_id) AS n_rows FROM stored
UNION ALL SELECT 'index', count(*) FROM stored UNION ALL SELECT 'columns', count(DISTINCT term) FROM stored
UNION ALL SELECT 'targets', count(DISTINCT target) FROM stored UNION ALL SELECT 'id_map', count(DISTINCT row_id) FROM stored
UNION ALL SELECT 'identity', 1""")
def _(spark, d):
    store = order_store(spark, d)
    S.create_store(store, "another uuid is ignored")
    counts = [S.scan(store, t).agg(F.lit(t).alias("table"), F.count("*").alias("n_rows")) for t in S.TABLES]
    return reduce(lambda a, b: a.union(b), counts)


@query("store_exists", """SELECT lang AS name, false AS found FROM documents GROUP BY lang UNION ALL SELECT 'orders', true""")
def _(spark, d):
    store = order_store(spark, d)
    names = [r["lang"] for r in table(spark, d, "documents").select("lang").distinct().collect()] + ["orders"]
    found = [(n, S.store_exists(S.Store(spark, store.root, n))) for n in names]
    return spark.createDataFrame(found, "name string, found boolean")


@query("delete_batch", f"WITH {STORE_CELLS} SELECT DISTINCT row_id, batch_id FROM stored WHERE batch_id = 'batch-f'")
def _(spark, d):
    store = copy_of(order_store(spark, d))
    S.delete_batch(store, "batch-op")
    return S.scan(store, "data").select("row_id", "batch_id")


@query("replay_batch", f"WITH {STORE_CELLS} SELECT row_id, target, term, value FROM stored")
def _(spark, d):
    """The first batch once more, after the second: no cell of either is lost."""
    store = copy_of(order_store(spark, d))
    S.append_batch(store, by_status(spark, d, order_frame_with_uid(spark, d), True), "batch-f", now())
    return S.scan_store(store).cells


@query("delete_first_batch", f"WITH {STORE_CELLS} SELECT row_id, target, term, value FROM stored WHERE batch_id = 'batch-op'")
def _(spark, d):
    """The cells that are left keep the names that the deleted batch brought in."""
    store = copy_of(order_store(spark, d))
    S.delete_batch(store, "batch-f")
    return S.scan_store(store).cells


@query("overwrite_store", f"WITH {STORE_CELLS} SELECT DISTINCT row_id, 'again' AS batch_id FROM stored")
def _(spark, d):
    store = copy_of(order_store(spark, d))
    S.overwrite_store(store, STORE_UUID)
    S.append_batch(store, order_frame(spark, d), "again", now())
    return S.scan(store, "data").select("row_id", "batch_id")


def _unreadable(cells):
    """The cells, of which some cannot be read."""
    bad = F.raise_error(F.lit("a value is no number")).cast("double")
    return cells.withColumn("value", F.when(F.col("term") == "A_UID", bad).otherwise(F.col("value")))


def _ingest(spark, store, cells, batch):
    book = new_folder(spark, "ledger")
    ledger.create_ledger(spark, book)
    return ingest_batch(store, cells.select("row_id", "target", "term", "value"), batch, book, now())


@query("failed_replay", f"WITH {STORE_CELLS} SELECT row_id, target, term, value, 'failed' AS status FROM stored")
def _(spark, d):
    """A stored batch is submitted again with unreadable values: all its cells stay."""
    store = copy_of(order_store(spark, d))
    frame = by_status(spark, d, order_frame_with_uid(spark, d), True)
    status = _ingest(spark, store, _unreadable(frame.cells), "batch-f")
    return S.scan_store(store).cells.withColumn("status", F.lit(status))


def _overwriting(store):
    return replace(store, config=replace(store.config, truncate_overwrite=True))


@query("interrupted_overwrite", f"WITH {STORE_CELLS} SELECT row_id, target, term, value, 'failed' AS status FROM stored")
def _(spark, d):
    """A batch that should take the place of the whole store cannot be read: the old store stays."""
    store = _overwriting(copy_of(order_store(spark, d)))
    status = _ingest(spark, store, _unreadable(order_frame_with_uid(spark, d).cells), "batch-new")
    return S.scan_store(store).cells.withColumn("status", F.lit(status))


NATIONS = "nations AS (SELECT 'nation-' || n_nationkey AS row_id, lower(r_name) AS target, 'n_' || lower(n_name) AS term, CAST(n_nationkey + 1 AS DOUBLE) AS value FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _nations(spark, d):
    joined = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("row_id"), F.col("r_name").alias("target"),
        F.concat(F.lit("n_"), "n_name").alias("term"), (F.col("n_nationkey") + 1.0).alias("value"),
    )


CLEAN = "lower(regexp_replace(term, '[^A-Za-z0-9_-]', '', 'g'))"


@query("truncate_overwrite", f"WITH {NATIONS} SELECT row_id, target, {CLEAN} AS term, value FROM nations")
def _(spark, d):
    store = _overwriting(copy_of(order_store(spark, d)))
    _ingest(spark, store, _nations(spark, d), "batch-new")
    return S.scan_store(store).cells


@query("replace_then_append", f"WITH {STORE_CELLS}, {NATIONS} SELECT row_id, target, term, value FROM stored UNION ALL SELECT row_id, target, {CLEAN}, value FROM nations")
def _(spark, d):
    """A vocabulary is replaced, then a batch with new names comes: every cell keeps its name."""
    store = copy_of(order_store(spark, d))
    S.replace_columns(store, S.scan_columns(store), "another store's")
    _ingest(spark, store, _nations(spark, d), "batch-new")
    return S.scan_store(store).cells


def _refused(spark, d, store, cells):
    book = new_folder(spark, "ledger")
    ledger.create_ledger(spark, book)
    ingest_batch(store, cells, "batch-new", book, now())
    n_rows = S.scan(store, "data").agg(F.count("*")).scalar()
    return ledger.read_ledger(spark, book).select("batch_id", "status", "error", n_rows.alias("n_rows"))


@query("colliding_names", f"""WITH {ORDERS} SELECT 'batch-new' AS batch_id, 'failed' AS status, 'Names of the batch collide once they are cleaned' AS error, count(*) AS n_rows FROM rws""")
def _(spark, d):
    """Two names of which nothing is left when they are cleaned would become one nameless column."""
    odd = _nations(spark, d).withColumn("term", F.when(F.col("value") > 12, "é").otherwise("ß"))
    return _refused(spark, d, copy_of(order_store(spark, d)), odd)


@query("ingest_misaligned", f"""WITH {ORDERS} SELECT 'batch-new' AS batch_id, 'failed' AS status, 'Rows changed in the numbering of the store' AS error, count(*) AS n_rows FROM rws""")
def _(spark, d):
    """The store's dictionary gives one number to two names: a batch that would come back changed is refused."""
    store = copy_of(order_store(spark, d))
    damaged = S.scan_columns(store).unionByName(_nations(spark, d).select(F.lower("term").alias("term"), F.lit(1).alias("idx")))
    S.replace_columns(store, damaged, "damaged")
    return _refused(spark, d, store, _nations(spark, d))


@query("store_row_count", f"WITH {ORDERS} SELECT count(*) AS n_rows FROM rws")
def _(spark, d):
    return S.scan(order_store(spark, d), "data").agg(F.count("*").alias("n_rows"))


@query("store_row_count_approx", f"WITH {ORDERS} SELECT count(*) AS n_rows FROM rws")
def _(spark, d):
    count = S.approximate_row_count(S.scan(order_store(spark, d), "data"), 60_000)
    return spark.createDataFrame([(int(count),)], "n_rows long")


@query("realign_to_store", f"""WITH {ORDERS}, t AS ({NUMBER_T.format("cells WHERE term <> 'Brand#1'")}), l AS ({NUMBER_L}),
lost AS (SELECT DISTINCT row_id FROM cells WHERE term = 'Brand#1')
SELECT row_id, l.idx AS target_idx, t.idx AS term_idx, value FROM cells c JOIN t ON c.term = t.term JOIN l ON c.target = l.target
WHERE row_id NOT IN (SELECT row_id FROM lost)""")
def _(spark, d):
    frame = order_frame(spark, d)
    known = number_terms(frame.cells.where("term <> 'Brand#1'"))
    return S.realign_to_store(frame, known, number_targets(frame.rows))


@query("match_schema", f"""WITH {LANG}, known AS ({NUMBER_T.format("cells WHERE target = 'en'")})
SELECT row_id, target, c.term, idx, value FROM cells c JOIN known k ON c.term = k.term""")
def _(spark, d):
    frame = document_frame(spark, d, "lang")
    return S.match_schema(frame, number_terms(frame.cells.where("target = 'en'")))


@query("validate_realigned", f"WITH {ORDERS} SELECT row_id, lower(term) AS term, 'lost' AS problem FROM cells WHERE term = 'Brand#3'")
def _(spark, d):
    cells = order_frame(spark, d).cells
    return S.validate_realigned(cells, cells.where("term <> 'Brand#3'"))


@query("validate_store_uuid", """SELECT user_id, event_type AS store, 'uuid-of-user-' || user_id AS batch_uuid,
 user_id = m AS accepted FROM (SELECT DISTINCT user_id, event_type FROM events)
 JOIN (SELECT event_type AS e, min(user_id) AS m FROM events WHERE event_type <> 'view' GROUP BY 1) ON event_type = e
UNION ALL SELECT DISTINCT user_id, event_type, 'uuid-of-user-' || user_id, false FROM events WHERE event_type = 'view'""")
def _(spark, d):
    events = table(spark, d, "events").select("user_id", F.col("event_type").alias("store")).distinct()
    uuid = F.concat(F.lit("uuid-of-user-"), F.col("user_id").cast("string"))
    identity = events.where("store <> 'view'").groupBy("store").agg(F.min("user_id").alias("user_id")).select(
        "store", uuid.alias("store_uuid")
    )
    return S.validate_store_uuid(events.withColumn("batch_uuid", uuid), identity)


@query("attach_uuid", """SELECT CAST(documents.doc_id AS VARCHAR) AS a_uid, 'row-' || labels.doc_id AS uuid FROM documents JOIN labels ON documents.doc_id = labels.doc_id
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'generated' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, d):
    id_map = table(spark, d, "labels").select(
        F.col("doc_id").cast("double").alias("old_id"), F.concat(F.lit("row-"), F.col("doc_id").cast("string")).alias("row_id")
    )
    supplement = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("a_uid"))
    out = S.attach_uuid(supplement, id_map, "a_uid")
    return out.select("a_uid", F.when(F.col("uuid").endswith("-x"), "generated").otherwise(F.col("uuid")).alias("uuid"))


@query("duplicate_probe", f"""WITH {LANG}, {HASHES}, i AS (SELECT row_hash FROM hashes JOIN labels ON row_id = CAST(doc_id AS VARCHAR)),
s AS (SELECT DISTINCT row_hash FROM hashes WHERE row_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))
SELECT count(*) AS n_rows, CAST(count(s.row_hash) AS BIGINT) AS n_known, round(count(s.row_hash) / count(*), 6) AS share
FROM i LEFT JOIN s ON i.row_hash = s.row_hash""")
def _(spark, d):
    hashes = row_hashes(document_frame(spark, d, "lang"))
    labelled = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("row_id"))
    incoming = hashes.join(labelled, "row_id", "left_semi")
    stored = hashes.join(labelled, "row_id", "left_anti")
    return S.duplicate_share(incoming, stored).withColumn("share", F.round("share", 6))


# --- reports ---------------------------------------------------------------------------


@query("write_single_csv", "SELECT o_orderpriority AS target, CAST(count(*) AS VARCHAR) AS n_rows FROM orders GROUP BY 1")
def _(spark, d):
    path = new_folder(spark, "single")
    T.write_single_csv(count_by_target(table(spark, d, "orders").withColumnRenamed("o_orderpriority", "target")), path)
    return T.read_header_csv(spark, path)


@query("report_counts_by_target", f"WITH {DOCS}, l AS ({NUMBER_L}) SELECT l.idx, r.target, count(*) AS n_rows FROM rws r JOIN l ON r.target = l.target GROUP BY ALL")
def _(spark, d):
    frame = document_frame(spark, d)
    return count_by_target(frame.rows).join(number_targets(frame.rows), "target")


@query("write_supplement_by_label", """WITH l AS (SELECT DISTINCT lang AS label FROM documents), s AS (SELECT CAST(doc_id AS VARCHAR) AS uuid, lang || source AS aa_label FROM documents)
SELECT label, uuid, aa_label FROM s JOIN l ON starts_with(aa_label, label) UNION ALL
SELECT 'ensrc1', uuid, aa_label FROM s WHERE starts_with(aa_label, 'ensrc1')""")
def _(spark, d):
    docs = table(spark, d, "documents")
    supplement = docs.select(F.col("doc_id").cast("string").alias("uuid"), F.concat("lang", "source").alias("aa_label"))
    labels = docs.select(F.concat(F.lit("#"), "lang").alias("target")).union(
        docs.where("lang = 'en'").select(F.lit("#ensrc1"))
    )
    path = new_folder(spark, "by-label")
    T.write_by_label(T.supplement_by_label(supplement, labels.distinct()), path)
    return T.read_header_csv(spark, path).select("label", "uuid", "aa_label")


def _filled_cache(spark, d):
    stamped = table(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("dsctimestamp"))
    path = new_folder(spark, "cache")
    cache.ttl_cache_append(stamped.where("event_id % 2 = 0"), path)
    cache.ttl_cache_append(stamped.where("event_id % 2 = 1"), path)
    return path


@query("ttl_cache_append", "SELECT event_id FROM events")
def _(spark, d):
    return cache.ttl_cache_read(spark, _filled_cache(spark, d), ttl_minutes=0).select("event_id")


@query("ttl_cache_read", f"""SELECT event_id FROM events
WHERE epoch_ms(ts) > epoch_ms({NOW}) - 1440 * 60000 * 7""")
def _(spark, d):
    path = _filled_cache(spark, d)
    return cache.ttl_cache_read(spark, path, F.unix_millis(now()), 1440 * 7).select("event_id")


@query("ttl_cache_clean", f"""SELECT event_id FROM events
WHERE epoch_ms(ts) > epoch_ms({NOW}) - 1440 * 60000 * 7""")
def _(spark, d):
    path = _filled_cache(spark, d)
    cache.ttl_cache_clean(spark, path, F.unix_millis(now()), 1440 * 7, above=0)
    return cache.ttl_cache_read(spark, path, ttl_minutes=0).select("event_id")


LEDGER = """entries AS (SELECT 'user-' || user_id AS batch_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'persisted' END AS status,
 CASE event_type WHEN 'error' THEN CASE WHEN user_id % 3 = 0 THEN 'Too many duplicate records ' WHEN user_id % 3 = 1 THEN 'Bad Line #7!'
 ELSE 'Something quite long went wrong: see log' END ELSE '' END AS error, ts, event_id FROM events),
 last AS (SELECT batch_id, arg_max(status, ts) AS status, arg_max(error, ts) AS error FROM entries GROUP BY batch_id)"""


@query("batch_ledger", f"""WITH {LEDGER} SELECT batch_id, status, CASE WHEN status <> 'failed' THEN '' WHEN starts_with(error, 'Too many') THEN 'duplicate-'
 WHEN starts_with(error, 'Bad') THEN 'badline7' ELSE 'Somethingquitelongwen' END AS error_code FROM last""")
def _(spark, d):
    user = F.col("user_id")
    error = (
        F.when(user % 3 == 0, "Too many duplicate records ")
        .when(user % 3 == 1, "Bad Line #7!")
        .otherwise("Something quite long went wrong: see log")
    )
    bad = F.col("event_type") == "error"
    entries = table(spark, d, "events").select(
        F.concat(F.lit("user-"), user.cast("string")).alias("batch_id"),
        F.when(bad, "failed").otherwise("persisted").alias("status"),
        F.when(bad, error).otherwise("").alias("error"),
        "ts",
    )
    return ledger.latest_status(ledger.with_code(entries))


@query("batch_stragglers", f"""SELECT 'user-' || user_id AS batch_id, 'failed' AS status, 'notprocessed' AS error_code FROM events
GROUP BY user_id
HAVING arg_max(event_type, ts) IN ('error', 'view') AND epoch_ms({NOW}) - epoch_ms(max(ts)) > 86400000""")
def _(spark, d):
    events = table(spark, d, "events").withColumn("batch_id", F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    batches = events.groupBy("batch_id").agg(F.max("ts").alias("modified"))
    last = events.groupBy("batch_id").agg(F.max_by("event_type", "ts").alias("last"))
    done = last.where("last NOT IN ('error', 'view')")
    return ledger.stragglers(batches, done, now(), 86_400_000).select("batch_id", "status", "error_code")

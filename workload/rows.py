"""Queries on labels and rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.frame import SparseFrame, document_frame, order_frame, table
from termloom.functions.text import any_of, cast_typed_columns, split_column
from termloom.operators import rows as R
from termloom.operators import targets as T
from termloom.operators.lookups import attach, lookup_join
from termloom.sources.store import filter_null_keys
from termloom.sources.tables import word_count
from workload.columns import cells_out
from workload.registry import CELLS_OUT, DOCS, HASHES, ORDERS, doc_ctes, median_cut, query

LANG = doc_ctes("lang")
COUNTS = "counts AS (SELECT target, count(*) AS n_rows FROM rws GROUP BY target)"


@query("count_by_target", f"WITH {ORDERS}, {COUNTS} SELECT * FROM counts")
def _(spark, d):
    return T.count_by_target(order_frame(spark, d).rows)


@query("row_sums", f"WITH {DOCS} SELECT row_id, sum(value) AS total FROM cells GROUP BY row_id")
def _(spark, d):
    return R.row_sums(document_frame(spark, d).cells)


@query("remove_targets", f"WITH {ORDERS} SELECT {CELLS_OUT} FROM cells WHERE target NOT IN ('5-LOW', '3-MEDIUM')")
def _(spark, d):
    return cells_out(T.remove_targets(order_frame(spark, d), ["5-LOW", "3-MEDIUM"]))


@query("subset_by_target", f"WITH {ORDERS} SELECT {CELLS_OUT} FROM cells WHERE target = '2-HIGH'")
def _(spark, d):
    return cells_out(T.subset_by_target(order_frame(spark, d), "2-HIGH"))


@query("rows_with_terms", f"""WITH {DOCS} SELECT row_id, target FROM cells WHERE term IN ('the', 'and') AND target = 'src3'
GROUP BY ALL HAVING count(*) = 2""")
def _(spark, d):
    return R.rows_with_terms(document_frame(spark, d).cells, ["the", "and"], "src3")


@query("trim_targets", f"""WITH {LANG}, {COUNTS} SELECT {CELLS_OUT} FROM cells WHERE target NOT IN
 (SELECT target FROM counts WHERE n_rows < 120 OR contains(target, 'BLANK') OR starts_with(target, 'REL') OR target = 'any subject')""")
def _(spark, d):
    return cells_out(T.trim_targets(document_frame(spark, d, "lang"), 120))


@query("predicate_any", f"""WITH {ORDERS}, {COUNTS} SELECT target, n_rows FROM counts
WHERE contains(target, 'MED') OR starts_with(target, '1') OR target = '5-LOW' OR n_rows < 10""")
def _(spark, d):
    name = F.col("target")
    tests = [name.contains("MED"), name.startswith("1"), name == "5-LOW", F.col("n_rows") < 10]
    return T.count_by_target(order_frame(spark, d).rows).where(any_of(tests))


@query("two_targets_above_median", f"""WITH {ORDERS}, {COUNTS}, u AS (SELECT DISTINCT n_rows FROM counts), {median_cut('m', 'u', 'n_rows')}
SELECT target, n_rows FROM counts, m WHERE n_rows > cut ORDER BY n_rows, target LIMIT 2""")
def _(spark, d):
    return T.two_targets_above_median(order_frame(spark, d))


@query("keep_two_targets", f"""WITH {ORDERS}, {COUNTS}, u AS (SELECT DISTINCT n_rows FROM counts), {median_cut('m', 'u', 'n_rows')},
top AS (SELECT target FROM counts, m WHERE n_rows > cut ORDER BY n_rows, target LIMIT 2)
SELECT {CELLS_OUT} FROM cells WHERE target IN (SELECT target FROM top)""")
def _(spark, d):
    return cells_out(T.keep_two_targets(order_frame(spark, d)))


@query("balance_targets", f"""WITH {LANG}, {COUNTS}, {median_cut('m', 'counts', 'n_rows')},
k AS (SELECT row_id, row_number() OVER (PARTITION BY target ORDER BY md5('s1' || row_id), row_id) AS rn FROM rws)
SELECT c.row_id, target, term, value FROM cells c JOIN k ON c.row_id = k.row_id, m WHERE rn <= cut""")
def _(spark, d):
    return T.balance_targets(document_frame(spark, d, "lang"), "s1").cells


@query("dichotomize_target", f"""WITH {ORDERS} SELECT row_id, CASE WHEN target = '1-URGENT' THEN target ELSE 'other' END AS target, term, value FROM cells""")
def _(spark, d):
    return T.dichotomize_target(order_frame(spark, d), "1-URGENT").cells


MERGED = """CASE target WHEN '#not specified' THEN '#low' WHEN '#urgent' THEN '#high' ELSE target END"""


def hash_labels(frame: SparseFrame) -> SparseFrame:
    """Labels in the form ``#name`` in lower case, without their leading number."""
    label = F.concat(F.lit("#"), F.lower(F.expr("substring(target, 3)")))
    return frame.with_rows(frame.rows.withColumn("target", label), frame.cells.withColumn("target", label))


HASH_LABELS = "'#' || lower(substr(target, 3))"


@query("merge_targets", f"""WITH {ORDERS}, h AS (SELECT row_id, {HASH_LABELS} AS target, term, value FROM cells)
SELECT row_id, {MERGED} AS target, term, value FROM h""")
def _(spark, d):
    pairs = [("NOT_SPECIFIED", "LOW"), ("URGENT", "HIGH"), ("LOW", "NO_SUCH_LABEL"), ("NOBODY", "HIGH")]
    merge_map = spark.createDataFrame(pairs, "old string, new string")
    return T.merge_targets(hash_labels(order_frame(spark, d)), merge_map).cells


@query("random_subset", f"""WITH {DOCS} SELECT row_id, target, term, value FROM cells
WHERE CAST('0x' || substr(md5('7|' || row_id), 1, 8) AS BIGINT) < CAST(floor(0.3 * 4294967296) AS BIGINT)""")
def _(spark, d):
    frame = R.random_subset(document_frame(spark, d), 0.3, 7)
    return frame.cells


@query("hash_sample", """SELECT o_orderkey, o_orderpriority FROM orders
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) AS INTEGER) < 6554""")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return R.hash_sample(orders, "o_orderkey", 6554)


@query("reservoir_sample", """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY md5('seed' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 500""")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.exact_sample(orders, "o_orderkey", 500, "seed")


@query("limit_rows", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100")
def _(spark, d):
    return R.limit_rows(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 100)


@query("row_hash", f"WITH {DOCS}, {HASHES} SELECT row_id, target, row_hash FROM hashes")
def _(spark, d):
    return R.row_hashes(document_frame(spark, d))


DUPES = """dup AS (SELECT target, row_hash, count(*) AS copies FROM hashes GROUP BY ALL HAVING count(*) > 1),
  tot AS (SELECT target, count(*) AS n_rows FROM rws GROUP BY target)"""


@query("distinct_rows", f"""WITH {LANG}, {HASHES}, f AS (SELECT min(row_id) AS row_id FROM hashes GROUP BY target, row_hash)
SELECT {CELLS_OUT} FROM cells WHERE row_id IN (SELECT row_id FROM f)""")
def _(spark, d):
    return cells_out(R.distinct_rows(document_frame(spark, d, "lang").materialise()))


@query("analyze_duplicates", f"""WITH {LANG}, {HASHES}, {DUPES}
SELECT dup.target, row_hash, copies, round(copies / n_rows, 6) AS share FROM dup JOIN tot ON dup.target = tot.target""")
def _(spark, d):
    return R.analyze_duplicates(document_frame(spark, d, "lang")).withColumn("share", F.round("share", 6))


@query("remove_overrepresented_duplicates", f"""WITH {LANG}, {HASHES}, {DUPES},
over AS (SELECT dup.target, row_hash FROM dup JOIN tot ON dup.target = tot.target WHERE copies / n_rows > CAST(0.005 AS DOUBLE))
SELECT {CELLS_OUT} FROM cells WHERE row_id IN (SELECT row_id FROM hashes WHERE (target, row_hash) NOT IN (SELECT target, row_hash FROM over))""")
def _(spark, d):
    return cells_out(R.remove_overrepresented_duplicates(document_frame(spark, d, "lang").materialise(), 0.005))


@query("remove_rows_by_hash", f"""WITH {LANG}, {HASHES}, {DUPES}
SELECT {CELLS_OUT} FROM cells WHERE row_id IN (SELECT row_id FROM hashes WHERE row_hash NOT IN (SELECT row_hash FROM dup))""")
def _(spark, d):
    frame = document_frame(spark, d, "lang").materialise()
    return cells_out(R.remove_rows_by_hash(frame, R.analyze_duplicates(frame)))


@query("filter_null_keys", """SELECT o_orderkey, label FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS label FROM orders) WHERE label IS NOT NULL""")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("label"))
    return filter_null_keys(orders, ["o_orderkey", "label"])


@query("cast_columns_by_type", "SELECT p_partkey, p_brand, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part")
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return cast_typed_columns(part, "int", "double")


@query("split_column", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS code, split_part(o_orderpriority, '-', 2) AS name FROM orders")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return split_column(orders, "o_orderpriority", "-", ["code", "name"])


@query("word_count", """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def _(spark, d):
    return word_count(table(spark, d, "documents"), "text")


@query("map_lookup", """SELECT c_custkey, coalesce(n_name, 'unknown') AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey""")
def _(spark, d):
    known = table(spark, d, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    found = lookup_join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), known, ["c_nationkey"], "left")
    return found.select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"))


@query("attach_group_share", f"""WITH {ORDERS} SELECT row_id, r.target, n_rows FROM rws r JOIN (SELECT target, count(*) AS n_rows FROM rws GROUP BY 1) t ON r.target = t.target""")
def _(spark, d):
    rows = order_frame(spark, d).rows
    return attach(rows, T.count_by_target(rows), ["target"])

"""Queries on scalar functions, phrases and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.frame import order_frame, table
from termloom.functions import text as X
from termloom.operators import classify, phrases
from termloom.operators.clusters import cluster_weight_stats, term_spread
from workload.fixtures import CLUSTERS, ORDER_SUPPLEMENT, cluster_report, order_supplement
from workload.registry import ORDERS, query


def docs(spark, d):
    return table(spark, d, "documents")


@query("str_clean", """SELECT doc_id, CASE WHEN regexp_matches(s, '^[_-]') THEN 'u' || s ELSE s END AS name FROM
 (SELECT doc_id, lower(regexp_replace('_' || url || '- ' || text, '[^A-Za-z0-9_-]', '', 'g')) AS s FROM documents LEFT JOIN pages ON page_id = doc_id)
WHERE s IS NOT NULL""")
def _(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "url")
    raw = docs(spark, d).join(pages, "doc_id")
    return raw.select("doc_id", X.clean_name(F.concat(F.lit("_"), "url", F.lit("- "), "text")).alias("name"))


@query("str_slice", """SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, substr(url, 1, 5) AS head,
 CAST(instr(url, '/') AS INTEGER) AS first_slash, CASE WHEN contains(url, '/') THEN regexp_extract(url, '([^/]*)$', 1) ELSE url END AS tail FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"),
        F.substring("url", 1, 5).alias("head"),
        F.instr("url", "/").alias("first_slash"),
        F.substring_index("url", "/", -1).alias("tail"),
    )


@query("str_match", """SELECT page_id, contains(url, 'www.') AS has_www, starts_with(url, 'https') AS secure, ends_with(url, 'top') AS at_top FROM pages""")
def _(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", url.contains("www.").alias("has_www"), url.startswith("https").alias("secure"), url.endswith("top").alias("at_top")
    )


@query("str_split_join", "SELECT doc_id, array_to_string(string_split(text, ' '), ', ') AS joined FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.concat_ws(", ", F.split("text", " ")).alias("joined"))


@query("str_file_safe", "SELECT page_id, translate(url, '|?''\"#*%', '_______') AS name FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", X.file_safe(F.col("url")).alias("name"))


@query("error_code", """SELECT conv_id, turn, CASE WHEN length(text) < 25 THEN regexp_replace(lower(text), '[^a-z0-9]', '', 'g')
 ELSE regexp_replace(substr(text, 1, 24), '[^A-Za-z0-9]', '', 'g') END AS code FROM conversations""")
def _(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", X.error_code(F.col("text")).alias("code"))


@query("num_round", "SELECT l_orderkey, l_linenumber, l_suppkey, round(l_extendedprice * l_discount, 4) AS value FROM lineitem")
def _(spark, d):
    lines = table(spark, d, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_suppkey", F.round(F.col("l_extendedprice") * F.col("l_discount"), 4).alias("value"))


@query("num_try_cast", """SELECT o_orderkey, coalesce(TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT), -1) AS code,
 coalesce(TRY_CAST(o_orderpriority AS DOUBLE), -1) AS bad FROM orders""")
def _(spark, d):
    first = F.substring_index("o_orderpriority", "-", 1)
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.coalesce(X.try_number(first, "bigint"), F.lit(-1)).alias("code"),
        F.coalesce(X.try_number(F.col("o_orderpriority")), F.lit(-1.0)).alias("bad"),
    )


@query("uuid_valid", "SELECT page_id, length(url) >= 12 AS valid, coalesce(length(nullif(substr(url, 1, 30), 'x')) >= 12, false) AS also FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select(
        "page_id", X.valid_uuid(F.col("url")).alias("valid"), X.valid_uuid(F.expr("nullif(substr(url, 1, 30), 'x')")).alias("also")
    )


@query("uuid_gen", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE o_orderstatus END AS id FROM orders")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderstatus END").alias("old"))
    made = orders.withColumn("id", X.id_or_new(F.col("old")))
    return made.select("o_orderkey", F.when(F.length("id") == 36, "new").otherwise(F.col("id")).alias("id"))


@query("date_stamp", "SELECT o_orderkey, year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) AS stamp FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "y-M-d").alias("stamp"))


def order_arrays(spark, d):
    """Per order the index and value arrays of its lines, in no particular order."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    packed = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "q")).alias("c"))
    return packed.select("l_orderkey", F.col("c.l_linenumber").alias("indices"), F.col("c.q").alias("values"))


OARR = "w AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY ALL)"


@query("arr_contains", f"WITH {OARR} SELECT l_orderkey FROM w WHERE l_linenumber IN (1, 3) GROUP BY l_orderkey HAVING count(*) = 2")
def _(spark, d):
    return order_arrays(spark, d).where(X.has_all(F.col("indices"), [1, 3])).select("l_orderkey")


@query("arr_zip_sort", f"WITH {OARR} SELECT l_orderkey, string_agg(l_linenumber || ':' || CAST(q AS BIGINT), ' ' ORDER BY l_linenumber) AS cells FROM w GROUP BY l_orderkey")
def _(spark, d):
    pairs = X.sorted_pairs(F.col("indices"), F.col("values"))
    text = F.transform(pairs, lambda p: F.concat_ws(":", p["idx"].cast("string"), p["value"].cast("bigint").cast("string")))
    return order_arrays(spark, d).select("l_orderkey", F.array_join(text, " ").alias("cells"))


@query("sort_indices", f"WITH {OARR} SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS indices FROM w GROUP BY l_orderkey")
def _(spark, d):
    from termloom.sources.store import repair_rows

    rows = order_arrays(spark, d).withColumn("row_id", F.col("l_orderkey").cast("string"))
    return repair_rows(rows).select("l_orderkey", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"))


@query("arr_value_at", f"WITH {OARR} SELECT l_orderkey, coalesce(max(CASE WHEN l_linenumber = 2 THEN q END), -1) AS second FROM w GROUP BY l_orderkey")
def _(spark, d):
    at = X.value_at(F.col("indices"), F.col("values"), F.lit(2))
    return order_arrays(spark, d).select("l_orderkey", F.coalesce(at, F.lit(-1.0)).alias("second"))


@query("arr_names", f"""WITH {ORDERS}, n AS (SELECT row_id, CAST(substr(term, 7, 2) AS INTEGER) AS idx, CASE WHEN term = 'Brand#5' THEN '?' ELSE term END AS term FROM cells)
SELECT row_id, string_agg(term, ' ' ORDER BY idx) AS names FROM n GROUP BY row_id""")
def _(spark, d):
    number = F.substring("term", 7, 2).cast("int")
    cells = order_frame(spark, d).cells.withColumn("idx", number)
    known = table(spark, d, "part").select(F.col("p_brand").alias("term")).distinct().where("term <> 'Brand#5'")
    return phrases.row_names(cells, known.withColumn("idx", number))


# --- user functions as column expressions -----------------------------------------------


@query("udf_code_value", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus || '_unknown' END AS code FROM orders")
def _(spark, d):
    from termloom.operators.assessment import code_lookup

    options = spark.createDataFrame([("F", "finished"), ("O", "open")], "option_id string, code string")
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("code"))
    renamed = options.withColumnRenamed("code", "code")
    return code_lookup(orders, renamed, "o_orderkey")


@query("udf_uuid", "SELECT doc_id, true AS ok FROM documents")
def _(spark, d):
    made = docs(spark, d).select("doc_id", F.concat(F.uuid(), F.lit("-x")).alias("u"))
    return made.select("doc_id", F.col("u").rlike("^[0-9a-f-]{36}-x$").alias("ok"))


# --- cluster reports and phrases ---------------------------------------------------------

LAST = """last AS (SELECT report.*, max(iteration) OVER (PARTITION BY target) AS m FROM report),
  kept AS (SELECT target, iteration, cluster, term, value FROM last WHERE iteration = m OR (m > 8 AND iteration = m // 2)),
  top AS (SELECT target, iteration, cluster, term, value, row_number() OVER (PARTITION BY target, cluster ORDER BY value DESC, term) AS rank FROM kept)"""


@query("last_iteration_terms", f"WITH {CLUSTERS}, {LAST} SELECT * FROM kept")
def _(spark, d):
    return phrases.last_iteration_terms(cluster_report(spark, d))


@query("top_terms_per_cluster", f"""WITH {CLUSTERS}, one AS (SELECT * FROM report WHERE iteration = 5)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, cluster ORDER BY value DESC, term) AS rank FROM one) WHERE rank <= 4""")
def _(spark, d):
    return phrases.top_terms_per_cluster(cluster_report(spark, d).where("iteration = 5"), 4)


@query("term_spread", f"WITH {CLUSTERS} SELECT term, count(*) - 1 AS spread FROM report WHERE target = 'ALL' GROUP BY term")
def _(spark, d):
    return term_spread(cluster_report(spark, d).where("target = 'ALL'"))


@query("cluster_weight_stats", f"""WITH {CLUSTERS}, r AS (SELECT cluster, -value AS neg, row_number() OVER (PARTITION BY cluster ORDER BY value DESC) AS rn,
 count(*) OVER (PARTITION BY cluster) AS n FROM report)
SELECT cluster, count(*) AS n_terms, max(-neg) AS max_value, round(avg(-neg), 6) AS mean_value, max(CASE WHEN rn = n // 2 + 1 THEN -neg END) AS mid_value FROM r GROUP BY cluster""")
def _(spark, d):
    out = cluster_weight_stats(cluster_report(spark, d))
    return out.withColumn("mean_value", F.round("mean_value", 6))


PAIRS = """pairs AS (SELECT a.target AS cluster_target, a.cluster, a.term AS term1, a.value AS value1, b.term AS term2, b.value AS value2
   FROM top a JOIN top b ON a.target = b.target AND a.cluster = b.cluster AND a.rank < b.rank WHERE a.rank <= 3 AND b.rank <= 3),
  hits AS (SELECT x.row_id, x.target, cluster_target, cluster, term1, value1, term2, value2 FROM pairs
   JOIN cells x ON x.term = term1 JOIN cells y ON y.term = term2 AND y.row_id = x.row_id
   WHERE cluster_target = 'ALL' OR cluster_target = x.target)"""


@query("term_pair_sentences", f"WITH {ORDERS}, {CLUSTERS}, {LAST}, {PAIRS} SELECT * FROM hits")
def _(spark, d):
    top = phrases.top_terms_per_cluster(phrases.last_iteration_terms(cluster_report(spark, d)), 3)
    return phrases.term_pair_sentences(order_frame(spark, d).materialise().cells, phrases.term_pairs(top))


PHRASES = f"{ORDERS}, {CLUSTERS}, {LAST}, {PAIRS}, {ORDER_SUPPLEMENT}"
PHRASE_COLUMNS = """hits.row_id, target, cluster_target, cluster, term1, value1, term2, value2, aa_label, rawsentence,
  regexp_replace(aa_label, '-$', '') AS label"""


@query("attach_supplement", f"WITH {PHRASES} SELECT hits.row_id, term1, term2, rawsentence, regexp_replace(aa_label, '-$', '') AS label FROM hits JOIN sup ON hits.row_id = sup.row_id")
def _(spark, d):
    top = phrases.top_terms_per_cluster(phrases.last_iteration_terms(cluster_report(spark, d)), 3)
    found = phrases.term_pair_sentences(order_frame(spark, d).cells, phrases.term_pairs(top)).select("row_id", "term1", "term2")
    return phrases.attach_supplement(found, order_supplement(spark, d)).drop("aa_label")


@query("phrase_analysis", f"WITH {PHRASES} SELECT {PHRASE_COLUMNS} FROM hits JOIN sup ON hits.row_id = sup.row_id")
def _(spark, d):
    return phrases.phrase_analysis(order_frame(spark, d).materialise(), cluster_report(spark, d), order_supplement(spark, d), 3)


@query("phrase_analysis_by_target", f"WITH {PHRASES} SELECT {PHRASE_COLUMNS} FROM hits JOIN sup ON hits.row_id = sup.row_id WHERE cluster_target <> 'ALL'")
def _(spark, d):
    return phrases.phrase_analysis_by_target(order_frame(spark, d).materialise(), cluster_report(spark, d), order_supplement(spark, d), 3)


@query("write_phrases", f"WITH {PHRASES} SELECT row_id, cluster, term1, term2, false AS ran_second_tier FROM hits")
def _(spark, d):
    from termloom.scratch import new_folder

    top = phrases.top_terms_per_cluster(phrases.last_iteration_terms(cluster_report(spark, d)), 3)
    found = phrases.term_pair_sentences(order_frame(spark, d).cells, phrases.term_pairs(top))
    path = new_folder(spark, "phrases")
    phrases.write_phrases(found.select("row_id", "cluster", "term1", "term2"), path)
    return spark.read.parquet(path)


@query("union_sentences", "SELECT doc_id, text FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, text FROM documents WHERE source = 'src1'")
def _(spark, d):
    texts = docs(spark, d)
    return phrases.union_sentences(
        texts.where("lang = 'en'").select("doc_id", "text"), texts.where("source = 'src1'").select("doc_id", "text")
    )


# --- evaluation ------------------------------------------------------------------------------

PREDICTIONS = """pred AS (SELECT CAST(ascii(o_orderstatus) % 3 AS DOUBLE) AS label,
  CAST(CASE WHEN o_totalprice > 400000 THEN 0 WHEN o_totalprice > 150000 THEN ascii(o_orderstatus) % 3 ELSE 2 END AS DOUBLE) AS prediction FROM orders)"""


def predictions(spark, d):
    code = F.ascii("o_orderstatus") % 3
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        code.cast("double").alias("label"),
        F.when(price > 400000, 0).when(price > 150000, code).otherwise(2).cast("double").alias("prediction"),
    )


@query("evaluate_multiclass", f"""WITH {PREDICTIONS}, per AS (SELECT label, count(*) AS actual, count(*) FILTER (label = prediction) AS hit FROM pred GROUP BY label),
g AS (SELECT prediction AS label, count(*) AS guessed FROM pred GROUP BY prediction),
pr AS (SELECT per.label, actual, hit, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS p, hit / actual AS r FROM per LEFT JOIN g ON per.label = g.label)
SELECT round(sum(hit) / sum(actual), 6) AS accuracy, round(sum(p * actual) / sum(actual), 6) AS weighted_precision, round(sum(r * actual) / sum(actual), 6) AS weighted_recall,
 round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * actual) / sum(actual), 6) AS f1 FROM pr""")
def _(spark, d):
    out = classify.evaluate_multiclass(predictions(spark, d))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("test_error", f"WITH {PREDICTIONS} SELECT count(*) AS n_rows, count(*) FILTER (label <> prediction) AS n_wrong, round(count(*) FILTER (label <> prediction) / count(*), 6) AS error FROM pred")
def _(spark, d):
    return classify.test_error(predictions(spark, d)).withColumn("error", F.round("error", 6))


@query("evaluate_auc", """WITH s AS (SELECT toxic AS label, round(n_chars / 500) / 100 AS score FROM labels JOIN documents ON labels.doc_id = documents.doc_id),
r AS (SELECT label, (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2) AS rk FROM s),
a AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n, sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS t FROM r)
SELECT p AS n_positive, n AS n_negative, round((t - p * (p + 1) / 2) / (p * n), 6) AS auc FROM a""")
def _(spark, d):
    texts = table(spark, d, "documents").select("doc_id", "n_chars")
    scored = table(spark, d, "labels").join(texts, "doc_id").select(
        F.col("toxic").alias("label"), (F.round(F.col("n_chars") / 500) / 100).alias("score")
    )
    return classify.evaluate_auc(scored).withColumn("auc", F.round("auc", 6))

"""Queries on columns, scaling and reductions."""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.frame import document_frame, order_frame, number_terms, table
from termloom.functions.text import clean_name
from termloom.operators import columns as C
from termloom.operators import scale as S
from termloom.operators.lookups import lookup_join
from termloom.operators.ranking import percentile_legacy, upper_median
from workload.registry import CELLS_OUT, DOCS, ORDERS, doc_ctes, legacy_cut, median_cut, query

BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def cells_out(frame):
    return frame.cells.select("row_id", "target", "term", F.round("value", 6).alias("value"))


def rounded_totals(cells):
    return cells.groupBy("term").agg(F.round(F.sum("value"), 6).alias("total"), F.count("*").alias("n_cells"))


TOTALS = "SELECT term, round(sum(value), 6) AS total, count(*) AS n_cells FROM {src} GROUP BY term"


@query("column_sums", f"WITH {DOCS} SELECT term, sum(value) AS total FROM cells GROUP BY term")
def _(spark, d):
    return C.column_sums(document_frame(spark, d).cells)


@query("column_sums_by_target", f"WITH {DOCS} SELECT target, term, sum(value) AS total FROM cells GROUP BY ALL")
def _(spark, d):
    return C.column_sums(document_frame(spark, d).cells, ["target"])


@query("column_proportion", f"""WITH {DOCS}
SELECT term, count(*) AS n_cells, round(count(*) / (SELECT count(*) FROM rws), 6) AS proportion FROM cells GROUP BY term""")
def _(spark, d):
    return C.column_proportion(document_frame(spark, d)).withColumn("proportion", F.round("proportion", 6))


STDDEV = """sd AS (SELECT term, sqrt(greatest(sum(value * value) / n - (sum(value) / n) * (sum(value) / n), 0)) AS stddev
     FROM cells, (SELECT CAST(count(*) AS DOUBLE) AS n FROM rws) GROUP BY term, n)"""


@query("column_stddevs", f"WITH {ORDERS}, {STDDEV} SELECT term, round(stddev, 6) AS stddev FROM sd")
def _(spark, d):
    return C.column_stddevs(order_frame(spark, d)).withColumn("stddev", F.round("stddev", 6))


@query("stddev_cuts", f"""WITH {ORDERS}, {STDDEV}, {legacy_cut('lo', 'sd', 'stddev', 20)}, {legacy_cut('hi', 'sd', 'stddev', 80)}
SELECT round(lo.cut, 6) AS low_cut, round(hi.cut, 6) AS high_cut FROM lo, hi""")
def _(spark, d):
    out = C.stddev_cuts(order_frame(spark, d))
    return out.select(F.round("low_cut", 6).alias("low_cut"), F.round("high_cut", 6).alias("high_cut"))


SUMS = "sums AS (SELECT term, sum(value) AS total FROM cells GROUP BY term)"
SUMS_T = "sums AS (SELECT target, term, sum(value) AS total FROM cells GROUP BY target, term)"


@query("upper_median", f"WITH {DOCS}, {SUMS_T}, {median_cut('m', 'sums', 'total', 'target')} SELECT target, cut AS median FROM m")
def _(spark, d):
    return upper_median(C.column_sums(document_frame(spark, d).cells, ["target"]), "total", ["target"])


@query("percentile_legacy", f"""WITH {DOCS}, {SUMS_T}, {legacy_cut('p', 'sums', 'total', 87.5, 'target')}
SELECT target, round(cut, 6) AS cut FROM p""")
def _(spark, d):
    sums = C.column_sums(document_frame(spark, d).cells, ["target"])
    return percentile_legacy(sums, "total", 87.5, ["target"]).withColumn("cut", F.round("cut", 6))


@query("remove_columns", f"WITH {ORDERS} SELECT {CELLS_OUT} FROM cells WHERE term NOT IN ('Brand#1', 'Brand#2', 'Brand#7')")
def _(spark, d):
    terms = C.term_table(spark, ["Brand#1", "Brand#2", "Brand#7"])
    return cells_out(C.remove_columns(order_frame(spark, d), terms))


@query("keep_columns", f"""WITH {DOCS} SELECT {CELLS_OUT} FROM cells
WHERE term IN (SELECT term FROM cells GROUP BY term HAVING count(*) >= 20)""")
def _(spark, d):
    frame = document_frame(spark, d).materialise()
    often = frame.cells.groupBy("term").agg(F.count("*").alias("n")).where("n >= 20")
    return cells_out(C.keep_columns(frame, often))


NUMBERED = "numbered AS (SELECT term, CAST(row_number() OVER (ORDER BY md5(term), term) AS INTEGER) AS idx FROM (SELECT DISTINCT term FROM cells))"


@query("reset_column_indices", f"""WITH {DOCS}, {NUMBERED}, often AS (SELECT term FROM cells GROUP BY term HAVING count(*) >= 3)
SELECT term, idx, CAST(row_number() OVER (ORDER BY idx) AS INTEGER) AS new_idx FROM numbered WHERE term IN (SELECT term FROM often)""")
def _(spark, d):
    cells = document_frame(spark, d).cells
    often = cells.groupBy("term").agg(F.count("*").alias("n")).where("n >= 3")
    return C.reset_column_indices(number_terms(cells).join(often, "term", "left_semi"))


@query("remove_stop_words", f"WITH {DOCS} SELECT {CELLS_OUT} FROM cells WHERE term NOT IN ('the', 'and', 'les', 'der', 'nosuchword')")
def _(spark, d):
    return cells_out(C.remove_stop_words(document_frame(spark, d), "The, AND,les , der,nosuchword,"))


@query("terms_not_kept", f"""WITH {DOCS} SELECT DISTINCT term FROM cells
WHERE term NOT IN (SELECT term FROM cells GROUP BY term HAVING count(*) >= 5)""")
def _(spark, d):
    cells = document_frame(spark, d).cells
    keep = cells.groupBy("term").agg(F.count("*").alias("n")).where("n >= 5")
    return C.terms_not_kept(cells.select("term").distinct(), keep)


@query("clean_column_names", f"""WITH {ORDERS}
SELECT row_id, target, lower(regexp_replace(term, '[^A-Za-z0-9_-]', '', 'g')) AS term, sum(value) AS value FROM cells GROUP BY ALL""")
def _(spark, d):
    return C.clean_terms(order_frame(spark, d), clean_name).cells


@query("strip_by_prefix", f"WITH {DOCS} SELECT {CELLS_OUT} FROM cells WHERE regexp_matches(term, '^(the|re|un)')")
def _(spark, d):
    return cells_out(C.strip_by_prefix(document_frame(spark, d), ["the", "re", "un"]))


@query("term_frequency", f"WITH {DOCS} SELECT row_id, target, term, round(value / sum(value) OVER (PARTITION BY row_id), 6) AS value FROM cells")
def _(spark, d):
    return cells_out(S.term_frequency(document_frame(spark, d)))


TFIDF = """tf AS (SELECT row_id, target, term, value / sum(value) OVER (PARTITION BY row_id) AS value FROM cells),
  idf AS (SELECT term, ln((SELECT CAST(count(*) AS DOUBLE) FROM rws) / count(*)) AS w FROM cells GROUP BY term),
  tfidf AS (SELECT row_id, target, tf.term, tf.value * w AS value FROM tf JOIN idf ON tf.term = idf.term)"""

TFIDF_T = """tf AS (SELECT row_id, target, term, value / sum(value) OVER (PARTITION BY row_id) AS value FROM cells),
  per AS (SELECT target, CAST(count(*) AS DOUBLE) AS n FROM rws GROUP BY target),
  idf AS (SELECT c.target, term, ln(any_value(n) / count(*)) AS w FROM cells c JOIN per p ON c.target = p.target GROUP BY c.target, term),
  tfidf AS (SELECT row_id, tf.target, tf.term, tf.value * w AS value FROM tf JOIN idf ON tf.term = idf.term AND tf.target = idf.target)"""


@query("inverse_document_frequency", f"""WITH {ORDERS}, {TFIDF}
SELECT row_id, target, c.term, round(c.value * w, 6) AS value FROM cells c JOIN idf ON c.term = idf.term""")
def _(spark, d):
    return cells_out(S.inverse_document_frequency(order_frame(spark, d).materialise()))


@query("tfidf", f"WITH {ORDERS}, {TFIDF} SELECT {CELLS_OUT} FROM tfidf")
def _(spark, d):
    return cells_out(S.tfidf(order_frame(spark, d).materialise()))


@query("tfidf_documents", f"WITH {DOCS}, {TFIDF} {TOTALS.format(src='tfidf')}")
def _(spark, d):
    return rounded_totals(S.tfidf(document_frame(spark, d).materialise()).cells)


@query("tfidf_by_target", f"WITH {ORDERS}, {TFIDF_T} SELECT {CELLS_OUT} FROM tfidf")
def _(spark, d):
    return cells_out(S.tfidf(order_frame(spark, d).materialise(), ["target"]))


@query("normalize_rows", f"WITH {ORDERS} SELECT row_id, target, term, round(value / sum(value) OVER (PARTITION BY row_id), 6) AS value FROM cells")
def _(spark, d):
    return cells_out(S.normalize_rows(order_frame(spark, d)))


@query("normalize_rows_then_columns", f"""WITH {ORDERS},
nr AS (SELECT row_id, target, term, value / sum(value) OVER (PARTITION BY row_id) AS value FROM cells)
SELECT row_id, target, term, round(value / sum(value) OVER (PARTITION BY term), 6) AS value FROM nr""")
def _(spark, d):
    return cells_out(S.normalize_rows_then_columns(order_frame(spark, d).materialise()))


@query("normalize_and_proportionalize", f"""WITH {DOCS},
s AS (SELECT target, term, sum(value) AS value FROM cells GROUP BY ALL),
nr AS (SELECT target, term, value / sum(value) OVER (PARTITION BY target) AS value FROM s)
SELECT target AS row_id, target, term, round(value / sum(value) OVER (PARTITION BY term), 6) AS value FROM nr""")
def _(spark, d):
    return cells_out(S.normalize_and_proportionalize(document_frame(spark, d)))


@query("reduce_to_target_by_sum", f"WITH {DOCS} SELECT target AS row_id, target, term, sum(value) AS value FROM cells GROUP BY target, term")
def _(spark, d):
    return cells_out(S.reduce_to_target_by_sum(document_frame(spark, d)))


@query("cell_op_constant", f"""WITH {ORDERS}
SELECT row_id, target, c.term, round(value - m, 6) AS value FROM cells c JOIN (SELECT term, avg(value) AS m FROM cells GROUP BY term) t ON c.term = t.term""")
def _(spark, d):
    frame = order_frame(spark, d).materialise()
    means = frame.cells.groupBy("term").agg(F.avg("value").alias("total"))
    return cells_out(S.cell_op_columns(frame, means, lambda cell, mean: cell - mean))


@query("cell_op_row_constant", f"WITH {ORDERS} SELECT row_id, target, term, round(value - max(value) OVER (PARTITION BY row_id), 6) AS value FROM cells")
def _(spark, d):
    return cells_out(S.cell_op_rows(order_frame(spark, d), F.max, lambda cell, top: cell - top))


@query("remove_low_frequency", f"""WITH {DOCS}, {SUMS}, {median_cut('m', 'sums', 'total')}
SELECT {CELLS_OUT} FROM cells WHERE term NOT IN (SELECT term FROM sums, m WHERE total < cut + 1)""")
def _(spark, d):
    return cells_out(C.remove_low_frequency(document_frame(spark, d).materialise(), 1.0))


@query("remove_low_frequency_by_target", f"""WITH {DOCS}, {SUMS_T}, {median_cut('m', 'sums', 'total', 'target')},
low AS (SELECT sums.target, term FROM sums JOIN m ON sums.target = m.target WHERE total < cut + 1)
SELECT {CELLS_OUT} FROM cells WHERE (target, term) NOT IN (SELECT target, term FROM low)""")
def _(spark, d):
    return cells_out(C.remove_low_frequency(document_frame(spark, d).materialise(), 1.0, ["target"]))


@query("remove_low_frequency_percentile", f"""WITH {DOCS}, {SUMS}, {legacy_cut('p', 'sums', 'total', 75)}
SELECT {CELLS_OUT} FROM cells WHERE term NOT IN (SELECT term FROM sums, p WHERE total < cut)""")
def _(spark, d):
    return cells_out(C.remove_low_frequency_percentile(document_frame(spark, d).materialise(), 75))


SHARES = "shares AS (SELECT term, count(*) AS n_cells, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM rws) AS proportion FROM cells GROUP BY term)"


@query("remove_high_frequency", f"""WITH {DOCS}, {SHARES}, {legacy_cut('p', 'shares', 'proportion', 99.5)}
SELECT {CELLS_OUT} FROM cells WHERE term NOT IN (SELECT term FROM shares, p WHERE proportion > cut)""")
def _(spark, d):
    return cells_out(C.remove_high_frequency(document_frame(spark, d).materialise(), 99.5))


@query("report_removed_terms", f"""WITH {DOCS}, {SHARES}, {legacy_cut('p', 'shares', 'proportion', 99.5)}
SELECT term, n_cells, round(proportion, 6) AS proportion FROM shares, p WHERE proportion > cut""")
def _(spark, d):
    out = C.high_frequency_terms(document_frame(spark, d), 99.5)
    return out.select("term", "n_cells", F.round("proportion", 6).alias("proportion"))


@query("remove_low_proportion", f"""WITH {DOCS}, {SHARES}
SELECT {CELLS_OUT} FROM cells WHERE term NOT IN (SELECT term FROM shares WHERE proportion < CAST(0.005 AS DOUBLE))""")
def _(spark, d):
    return cells_out(C.remove_by_proportion(document_frame(spark, d).materialise()))


@query("keep_middle_proportion", f"""WITH {DOCS}, {SHARES}
SELECT {CELLS_OUT} FROM cells WHERE term NOT IN
 (SELECT term FROM shares WHERE proportion < CAST(0.01 AS DOUBLE) OR proportion > CAST(0.2 AS DOUBLE))""")
def _(spark, d):
    return cells_out(C.remove_by_proportion(document_frame(spark, d).materialise(), 0.01, 0.2))


@query("reduce_by_tfidf", f"""WITH {DOCS}, {TFIDF}, ts AS (SELECT term, round(sum(value), 9) AS total FROM tfidf GROUP BY term),
{legacy_cut('p', 'ts', 'total', 40)}
SELECT {CELLS_OUT} FROM cells WHERE term NOT IN (SELECT term FROM ts, p WHERE total < cut)""")
def _(spark, d):
    return cells_out(C.reduce_by_tfidf(document_frame(spark, d).materialise(), 40))


@query("flush_trim", f"""WITH {DOCS}, {SUMS}, {median_cut('m', 'sums', 'total')}
SELECT {CELLS_OUT} FROM cells WHERE term NOT IN (SELECT term FROM sums, m WHERE total < cut)""")
def _(spark, d):
    return cells_out(C.remove_low_frequency(document_frame(spark, d).materialise(), 0.0))


PIVOT = ", ".join(f"coalesce(sum(CASE WHEN term = '{b}' THEN value END), 0) AS \"{b}\"" for b in BRANDS)


@query("dense_pivot", f"WITH {ORDERS} SELECT r.row_id, r.target, {PIVOT} FROM rws r LEFT JOIN cells c ON r.row_id = c.row_id GROUP BY r.row_id, r.target")
def _(spark, d):
    return S.dense_pivot(order_frame(spark, d), BRANDS)


D2S = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]


@query("dense_to_sparse", """
WITH w AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_partkey AS row_id, l_returnflag AS target,
  CAST(max(l_linenumber) AS DOUBLE) AS l_linenumber, max(l_quantity) AS l_quantity, max(l_discount) AS l_discount, max(l_tax) AS l_tax FROM lineitem GROUP BY 1, 2),
t AS (SELECT target, CAST(row_number() OVER (ORDER BY n DESC, target) - 1 AS DOUBLE) AS label FROM (SELECT target, count(*) AS n FROM w GROUP BY 1)),
u AS (UNPIVOT w ON l_linenumber, l_quantity, l_discount, l_tax INTO NAME term VALUE value)
SELECT row_id, u.target, label, term, value FROM u JOIN t ON u.target = t.target WHERE value > 0""")
def _(spark, d):
    lines = table(spark, d, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    wide = lines.groupBy(key.alias("row_id"), F.col("l_returnflag").alias("target")).agg(
        *[F.max(c).cast("double").alias(c) for c in D2S]
    )
    frame = S.dense_to_sparse(wide, "row_id", "target", D2S)
    labels = frame.targets.withColumnRenamed("idx", "label")
    return lookup_join(frame.cells, labels, ["target"]).select("row_id", "target", "label", "term", "value")


@query("group_sum_wide", """SELECT l_returnflag, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
 round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax FROM lineitem GROUP BY l_returnflag""")
def _(spark, d):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = C.wide_sums(table(spark, d, "lineitem"), names, ["l_returnflag"])
    return out.select("l_returnflag", *[F.round(n, 2).alias(n) for n in names])


@query("wide_column_sums", """SELECT round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
 round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax FROM lineitem""")
def _(spark, d):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return C.wide_sums(table(spark, d, "lineitem"), names).select(*[F.round(n, 2).alias(n) for n in names])


@query("drop_below_median", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def _(spark, d):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return C.drop_below_median(table(spark, d, "lineitem").select("l_orderkey", *names), names)


@query("validate_columns_match", f"""WITH {DOCS}, k AS (SELECT DISTINCT term FROM cells WHERE term NOT IN ('the', 'and')),
u AS (SELECT DISTINCT term FROM cells)
SELECT count(u.term) AS n_used, count(k.term) AS n_known, count(*) FILTER (u.term IS NULL OR k.term IS NULL) AS n_mismatch,
 count(*) FILTER (u.term IS NULL OR k.term IS NULL) = 0 AS matches FROM u FULL JOIN k ON u.term = k.term""")
def _(spark, d):
    cells = document_frame(spark, d).cells
    return C.validate_columns_match(cells, cells.where("term NOT IN ('the', 'and')").select("term"))


EN = "(SELECT DISTINCT term FROM cells WHERE target = 'en')"
FR = "(SELECT DISTINCT term FROM cells WHERE target = 'fr')"


def _two_vocabularies(spark, d):
    cells = document_frame(spark, d, "lang").cells
    return tuple(cells.where(F.col("target") == lang).select("term").distinct() for lang in ("en", "fr"))


@query("union_terms", f"WITH {doc_ctes('lang')} SELECT term FROM {EN} UNION SELECT term FROM {FR}")
def _(spark, d):
    return C.union_terms(*_two_vocabularies(spark, d))


@query("except_terms", f"WITH {doc_ctes('lang')} SELECT term FROM {EN} EXCEPT SELECT term FROM {FR}")
def _(spark, d):
    return C.except_terms(*_two_vocabularies(spark, d))

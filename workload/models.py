"""Queries that fit models. Fits are iterative, so most are checked by rows only."""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.frame import SparseFrame, document_frame, order_frame, table
from termloom.operators import classify as M
from termloom.operators import clusters as K
from termloom.operators.columns import keep_columns
from termloom.operators.grouped import nearest
from termloom.operators.lookups import lookup_join, measured
from termloom.operators.phrases import last_iteration_terms, row_names, term_pair_sentences, term_pairs, top_terms_per_cluster
from termloom.operators.ranking import top_per_group
from termloom.scratch import publish
from workload.fixtures import cluster_report, once
from workload.registry import ORDERS, query

SMALL = K.CycleSettings(k=4, top_terms=5)


@once
def order_vectors(spark, d):
    return K.vectors(order_frame(spark, d))


@once
def document_words(spark, d):
    """Documents by language over all their words."""
    return document_frame(spark, d, "lang").materialise()


@once
def document_vectors(spark, d):
    return K.vectors(document_words(spark, d))


@query("kmeans_fit")
def _(spark, d):
    data = order_vectors(spark, d)
    model = K.kmeans_fit(data, 5)
    cost = model.summary.trainingCost
    sizes = model.transform(data.rows).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n_rows"))
    return sizes.withColumn("within_set_squared_error", F.lit(cost))


@query("lda_fit")
def _(spark, d):
    model = K.lda_fit(order_vectors(spark, d), 4)
    return model.transform(order_vectors(spark, d).rows).select("row_id", "target", F.col("topicDistribution").cast("string"))


@query("top_topic_terms")
def _(spark, d):
    data = order_vectors(spark, d)
    return K.top_topic_terms(K.lda_fit(data, 4), data.columns, 6)


@query("top_center_terms")
def _(spark, d):
    data = order_vectors(spark, d)
    return K.top_center_terms(spark, K.kmeans_fit(data, 5), data.columns, 6)


@query("kmeans_trim_cycle")
def _(spark, d):
    return K.kmeans_trim_cycle(order_frame(spark, d), SMALL)


@query("lda_trim_cycle")
def _(spark, d):
    return K.lda_trim_cycle(order_frame(spark, d), SMALL)


@query("kmeans_by_target")
def _(spark, d):
    return K.cycle_by_target(order_frame(spark, d), "kmeans", K.CycleSettings(k=4, top_terms=5))


@query("kmeans_round_by_target", f"""WITH {ORDERS},
    start AS (SELECT target, row_id, row_number() OVER (PARTITION BY target ORDER BY CAST(row_id AS BIGINT)) - 1 AS cluster FROM (SELECT DISTINCT row_id, target FROM cells)),
    centre AS (SELECT target, cluster, term, value FROM cells JOIN (SELECT * FROM start WHERE cluster < 3) USING (target, row_id)),
    norm AS (SELECT target, cluster, sum(value * value) AS n FROM centre GROUP BY ALL),
    own AS (SELECT target, row_id, sum(value * value) AS n FROM cells GROUP BY ALL),
    dot AS (SELECT c.target, c.row_id, e.cluster, sum(c.value * e.value) AS d FROM cells c JOIN centre e ON c.target = e.target AND c.term = e.term GROUP BY ALL),
    dist AS (SELECT own.target, own.row_id, norm.cluster, own.n + norm.n - 2 * coalesce(d, 0) AS apart
             FROM own JOIN norm ON own.target = norm.target
             LEFT JOIN dot ON dot.target = own.target AND dot.row_id = own.row_id AND dot.cluster = norm.cluster),
    near AS (SELECT *, row_number() OVER (PARTITION BY target, row_id ORDER BY apart, cluster) AS rn FROM dist)
    SELECT target, cluster, count(*) AS n_rows, CAST(sum(apart) AS DOUBLE) AS apart FROM near WHERE rn = 1 GROUP BY target, cluster""")
def _(spark, d):
    """One round from fixed starts, all labels together: sizes and squared distances."""
    cells = publish(order_frame(spark, d).cells, "cells")
    ids = cells.select("target", "row_id").distinct()
    first = top_per_group(ids, ["target"], [F.col("row_id").cast("long")], 3)
    starts = lookup_join(cells, first, ["target", "row_id"]).select("target", (F.col("rank") - 1).cast("int").alias("cluster"), "term", "value")
    found = nearest(cells, starts, 3)
    return found.groupBy("target", F.col("cluster").cast("long").alias("cluster")).agg(F.count("*").alias("n_rows"), F.sum("apart").alias("apart"))


@query("lda_by_target")
def _(spark, d):
    return K.cycle_by_target(order_frame(spark, d), "lda", K.CycleSettings(k=3, top_terms=5))


@query("reduce_by_clustering")
def _(spark, d):
    return K.reduce_by_clustering(order_frame(spark, d), K.CycleSettings(k=3, top_terms=4)).cells


@query("reduce_by_clustering_by_target")
def _(spark, d):
    return K.reduce_by_clustering_by_target(order_frame(spark, d), K.CycleSettings(k=2, top_terms=4)).cells


@query("second_tier_clusters")
def _(spark, d):
    frame = order_frame(spark, d).materialise()
    top = top_terms_per_cluster(last_iteration_terms(cluster_report(spark, d).where("target = 'ALL'")), 3)
    return K.second_tier_clusters(frame, term_pair_sentences(frame.cells, term_pairs(top)))


@once
def svm_models(spark, d):
    return M.svm_one_vs_rest(document_words(spark, d))


@query("svm_one_vs_rest")
def _(spark, d):
    from pyspark.ml.classification import LinearSVCModel

    sizes = [(label, LinearSVCModel.load(path).numFeatures) for label, path in svm_models(spark, d).items()]
    return spark.createDataFrame(sizes, "label string, n_terms long")


@query("svm_predict")
def _(spark, d):
    frame = document_words(spark, d)
    return M.svm_predict(frame.cells, svm_models(spark, d), row_names(frame.cells))


@query("classify_pages")
def _(spark, d):
    """Learn languages from documents, then name the language of pages by url and title."""
    data = document_vectors(spark, d)
    train, labels = M.labelled(data)
    model = M.mlp_fit(train, data.columns.count(), labels.count())
    cells = M.page_tokens(table(spark, d, "pages")).withColumn("target", F.lit("page"))
    known = keep_columns(SparseFrame(cells.select("row_id", "target").distinct(), cells), data.columns)
    pages = K.pack_vectors(publish(known.cells, "cells"), measured(data.columns))
    scored = model.transform(pages).select("row_id", F.col("prediction").alias("label"))
    return lookup_join(scored, labels, ["label"]).select(F.col("row_id").alias("page_id"), F.col("target").alias("lang"))


@query("mlp_fit")
def _(spark, d):
    data = document_vectors(spark, d)
    rows, labels = M.labelled(data)
    train, test = M.split_by_hash(rows, 0.9)
    model = M.mlp_fit(train, data.columns.count(), labels.count())
    return M.evaluate_multiclass(model.transform(test).select("label", "prediction"))


@query("random_forest_fit")
def _(spark, d):
    rows, _ = M.labelled(document_vectors(spark, d))
    train, test = M.split_by_hash(rows, 0.7)
    model = M.random_forest_fit(train)
    return M.test_error(model.transform(test).select("label", "prediction"))


@query("random_forest_predict")
def _(spark, d):
    rows, labels = M.labelled(document_vectors(spark, d))
    train, test = M.split_by_hash(rows, 0.7)
    scored = M.random_forest_fit(train).transform(test).select("row_id", F.col("prediction").alias("label"))
    return lookup_join(scored, labels, ["label"]).select("row_id", "target")


@query("decision_tree_fit")
def _(spark, d):
    data = document_vectors(spark, d)
    rows, _ = M.labelled(data)
    train, _ = M.split_by_hash(rows, 0.7)
    return M.tree_terms(M.decision_tree_fit(train), data.columns)


@query("decision_tree_error")
def _(spark, d):
    rows, _ = M.labelled(document_vectors(spark, d))
    train, test = M.split_by_hash(rows, 0.7)
    return M.test_error(M.decision_tree_fit(train).transform(test).select("label", "prediction"))

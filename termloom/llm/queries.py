"""The registered queries of this subpackage, and SQL where it can be written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.alignment import alignment_scores
from termloom.llm.bpe import decode_ids, encode_texts
from termloom.llm.common import crc_share, table
from termloom.llm.conversations import prefix_trie, rebuilt_conversations, turn_lists
from termloom.llm.ctw import lm_scores
from termloom.llm.decontaminate import benchmark_hits
from termloom.llm.knn import top_inner
from termloom.llm.licenses import license_digest, scan_licenses
from termloom.llm.mixing import MIX_SQL, mix_sources
from termloom.llm.quality import fit_quality, score_quality
from termloom.llm.simhash import simhash_groups
from termloom.llm.substrings import remove_repeats
from termloom.llm.tokens import apply_edits, build_trees
from termloom.llm.toxicity import fit_toxicity, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_share("doc_id", 5) == 0
    machine = fit_toxicity(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    scored = score_toxicity(docs.select("doc_id", "text"), machine)
    score = F.col("toxicity")
    return scored.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


@query
def op3_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_share("doc_id", 4) == 2
    model = fit_quality(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    scored = score_quality(docs, model)
    score = F.col("quality_score")
    return scored.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.7).cast("int").alias("predicted"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(scan_licenses(table(spark, sf_dir, "documents")))


@query
def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), size=3, budget=2)


@query
def op4_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64.0)


SQL["op4_voronoi_topk"] = """
WITH u AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
e AS (SELECT vec_id, min(v) AS v FROM u GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM r WHERE rn <= 20"""


@query
def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL["op5_pareto_mix"] = MIX_SQL


@query
def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), size=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL["op9_repeated_passages"] = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win FROM w),
f AS (SELECT win, min(doc_id) AS first FROM g GROUP BY win),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM g JOIN f USING (win) WHERE first < doc_id),
x AS (SELECT doc_id, list(j) AS gone, count(*) AS n FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN ws ELSE [ws[k] FOR k IN range(1, len(ws) + 1) IF NOT list_contains(gone, k)] END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN x ON d.doc_id = x.doc_id"""


@query
def op2_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_share("doc_id", 10) == 0
    scored = lm_scores(table(spark, sf_dir, "documents"), learn_from=~held_out)
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    return scored.select("doc_id", held_out.alias("held_out"), *names)


def derived_edits():
    """Three edits of every text, from its own row: a cut, an inserted source name, a replaced stretch."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")

    def place(salt: str):
        return F.pmod(F.crc32(F.concat_ws("|", F.col("doc_id").cast("string"), F.lit(salt)).cast("binary")), size + 1)

    def change(at, width: int, insert):
        return F.struct(at.alias("start"), (at + width).alias("stop"), insert.cast("string").alias("insert"))

    return F.array(
        change(place("cut"), 23, F.lit("")),
        change(place("insert"), 0, F.concat(F.lit(" "), F.coalesce("source", F.lit("?")), F.lit(" "), F.col("doc_id").cast("string"))),
        change(place("replace"), 9, F.lit("it's\n\n  edited")),
    )


@query
def op6_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("edits", derived_edits())
    edited = apply_edits(build_trees(docs, keep=("edits",)))
    return edited.select(
        "doc_id", F.col("n_before").alias("tokens_before"), F.col("n_tokens").alias("tokens_after"), "n_edits",
        F.size("leaf_chars").cast("long").alias("n_pretokens"), "n_encoded",
    )


@query
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_scores(table(spark, sf_dir, "documents"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = turn_lists(table(spark, sf_dir, "conversations"))
    model = F.col("conv_id") - F.col("conv_id") % 100
    return prefix_trie(rebuilt_conversations(lists, model, crc_share("conv_id", 6)))


# The first three steps write crc32 of the decimal id out, by a table made from its polynomial.
SQL["op12_conversation_trie"] = """
WITH k AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
             lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
i AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS model, xor(4294967295, list_reduce([4294967295] || list_transform(
        string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1]))) % 6 AS h FROM i, k),
t AS (SELECT conv_id, md5(concat(length(r), ':', r, ':', x)) AS w, length(x) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) AS p
      FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
m AS (SELECT conv_id AS model, count(*) AS own FROM t GROUP BY conv_id),
a AS (SELECT c.conv_id, p AS d, w, n FROM c JOIN t ON t.conv_id = c.model AND p <= h
      UNION ALL SELECT c.conv_id, least(h, coalesce(own, 0)) + p - h, w, n FROM c JOIN t ON t.conv_id = c.conv_id AND p > h LEFT JOIN m USING (model)),
g AS (SELECT conv_id, d, string_agg(w, '') OVER (PARTITION BY conv_id ORDER BY d) AS node, n FROM a
      UNION ALL SELECT conv_id, 0, '', 0 FROM c),
v AS (SELECT node, min(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS n FROM g GROUP BY node),
q AS (SELECT left(node, 32 * (d - 1)) AS node, count(*) AS n_children FROM v WHERE d > 0 GROUP BY ALL),
e AS (SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
      FROM (SELECT conv_id, node FROM g QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY d DESC) = 1) GROUP BY node),
u AS (SELECT left(v.node, 32 * unnest(range(d + 1))) AS node, (n_convs - 1) * n AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM v LEFT JOIN q USING (node)),
z AS (SELECT node, sum(saved) AS saved, sum(leaf) AS leaves FROM u GROUP BY node)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM v JOIN z USING (node) LEFT JOIN q USING (node) LEFT JOIN e USING (node) LEFT JOIN v o ON v.d > 0 AND o.node = left(v.node, 32 * (v.d - 1))"""


@query
def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode_ids(encode_texts(table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )

"""Queries on survey-style assessments.

The answer table is one row per order; its seven items are the line numbers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.frame import table
from termloom.functions.text import select_by_name
from termloom.operators import assessment as A
from termloom.scratch import new_folder
from termloom.sources.tables import clean_column_names, read_assessment, write_single_csv
from workload.registry import query

ITEMS = range(1, 8)
HEADINGS = {"1": "Order status?", "2": "The priority of the order at hand"}
STATUS, PRIORITY = "orderstatus", "thepriorityoftheo"


def wide(spark, d):
    """A_RowId, status, two demographics and one score column per item, all as text."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        *[
            F.max(F.when(F.col("l_linenumber") == i, F.col("l_quantity").cast("int") % 6 - 1)).cast("string").alias(f"1637_{i}_@SCORE")
            for i in ITEMS
        ]
    )
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderkey").cast("string").alias("A_RowId"),
        F.when(F.col("o_orderstatus") == "P", "Started").otherwise("TSICompleted").alias("A_Final_Status"),
        F.col("o_orderstatus").alias("182025_1_response_0"),
        F.col("o_orderpriority").alias("182025_2_response_0"),
        F.col("o_totalprice").cast("int").cast("string").alias("1637_duration"),
    )
    return orders.join(lines, "l_orderkey", "left").drop("l_orderkey")


SCORES = ", ".join(
    f"CAST(max(CASE WHEN l_linenumber = {i} THEN CAST(l_quantity AS INTEGER) % 6 - 1 END) AS VARCHAR) AS \"1637_{i}_@SCORE\"" for i in ITEMS
)
WIDE = f"""li AS (SELECT l_orderkey, {SCORES} FROM lineitem GROUP BY l_orderkey),
  wide AS (SELECT CAST(o_orderkey AS VARCHAR) AS "A_RowId", CASE WHEN o_orderstatus = 'P' THEN 'Started' ELSE 'TSICompleted' END AS "A_Final_Status",
   o_orderstatus AS "182025_1_response_0", o_orderpriority AS "182025_2_response_0", CAST(CAST(trunc(o_totalprice) AS INTEGER) AS VARCHAR) AS "1637_duration",
   li.* EXCLUDE (l_orderkey) FROM orders LEFT JOIN li ON o_orderkey = l_orderkey)"""


def items(spark, d):
    """Item meta data drawn from the parts: kind, round and subject of each item."""
    number = F.col("p_partkey") % 7 + 1
    kind = F.concat(
        F.lit("cet_R0"), ((F.col("n") - 1) % 3 + 1).cast("string"), F.when(F.col("n") % 2 == 0, "_Ipsative").otherwise("_Likert")
    )
    per = table(spark, d, "part").groupBy(number.alias("n")).agg(F.max_by("p_type", "p_partkey").alias("major"))
    return per.select(F.col("n").cast("string").alias("item_id"), kind.alias("item_type"), "major")


META = """meta0 AS (SELECT p_partkey % 7 + 1 AS n, arg_max(p_type, p_partkey) AS major FROM part GROUP BY 1),
  meta1 AS (SELECT n, CAST(n AS VARCHAR) AS item_id, 'cet_R0' || ((n - 1) % 3 + 1) || CASE WHEN n % 2 = 0 THEN '_Ipsative' ELSE '_Likert' END AS item_type, major,
    CAST((n - 1) % 3 + 1 AS VARCHAR) AS round FROM meta0),
  meta2 AS (SELECT *, CASE WHEN n % 2 = 0 THEN 'f' ELSE 'L' END || round || CASE WHEN length(major) < 5 THEN major ELSE substr(major, 1, 3) || right(major, 2) END AS base FROM meta1),
  meta AS (SELECT *, lower(base || row_number() OVER (PARTITION BY base ORDER BY n)) AS var_name FROM meta2)"""

LONG = f"""{WIDE}, {META}, done AS (SELECT * FROM wide WHERE "A_Final_Status" = 'TSICompleted'),
  u AS (UNPIVOT done ON COLUMNS('@SCORE') INTO NAME heading VALUE v),
  ans AS (SELECT "A_RowId", n, var_name AS item, CAST(v AS DOUBLE) AS value FROM u JOIN meta ON heading = '1637_' || n || '_@SCORE')"""

AVERAGES = f"""{LONG}, lik AS (SELECT *, CAST(substr(item, 2, 1) AS INTEGER) AS round FROM ans WHERE starts_with(item, 'l')),
  av AS (SELECT "A_RowId", round, coalesce(avg(CASE WHEN value >= 0 AND value < 4 THEN value END), -9999) AS average FROM lik GROUP BY ALL),
  dev AS (SELECT lik."A_RowId", lik.round, n, item, average, CASE WHEN value >= 0 THEN value - average ELSE -9999 END AS deviation
    FROM lik JOIN av ON lik."A_RowId" = av."A_RowId" AND lik.round = av.round)"""

TOP = f"""{LONG}, sc AS (SELECT "A_RowId", substr(item, 3, length(item) - 3) AS subject, sum(value * CASE WHEN starts_with(item, 'f') THEN 3 ELSE 1 END) AS score FROM ans GROUP BY ALL),
  best AS (SELECT "A_RowId", subject, score, row_number() OVER (PARTITION BY "A_RowId" ORDER BY score DESC, subject) AS rn FROM sc WHERE score > 0),
  choice AS (SELECT DISTINCT sc."A_RowId", coalesce(subject_b, '') AS final_choice, coalesce(score_b, 0) AS top_score FROM sc
    LEFT JOIN (SELECT "A_RowId" AS k, subject AS subject_b, score AS score_b FROM best WHERE rn = 1) ON k = sc."A_RowId")"""


def answers(spark, d):
    scored = A.drop_non_score_columns(A.filter_complete(wide(spark, d)))
    item_map = A.rename_score_columns(A.item_headings(scored), items(spark, d))
    return A.long_answers(A.apply_names(scored, item_map))


def demographics(spark, d):
    named = A.rename_demographic_columns(A.demographic_columns(A.filter_complete(wide(spark, d))), HEADINGS)
    return named


@query("read_assessment", f"WITH {WIDE} SELECT * FROM wide")
def _(spark, d):
    path = new_folder(spark, "assessment")
    wide(spark, d).write.csv(path, header=True)
    return read_assessment(spark, path)


@query("filter_complete", f"""WITH {WIDE} SELECT * FROM wide WHERE "A_Final_Status" = 'TSICompleted'""")
def _(spark, d):
    return A.filter_complete(wide(spark, d))


@query("select_columns_by_pattern", f"""WITH {WIDE} SELECT "A_RowId", "182025_1_response_0", "182025_2_response_0" FROM wide""")
def _(spark, d):
    return A.demographic_columns(wide(spark, d))


@query("drop_columns_by_pattern", f"""WITH {WIDE} SELECT * EXCLUDE ("182025_1_response_0", "182025_2_response_0") FROM wide""")
def _(spark, d):
    return A.drop_non_score_columns(wide(spark, d))


@query("columns_of_round", "SELECT l_orderkey AS a_rowid, l_linenumber, l_quantity AS l_qty FROM lineitem")
def _(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("a_rowid"), "l_linenumber", F.col("l_quantity").alias("l_qty"), F.col("l_tax").alias("tax")
    )
    return A.columns_of_round(lines, "l_")


@query("clean_header_names", """SELECT o_orderkey AS orderkey1, o_orderstatus AS u_order-status, o_orderpriority AS u-priority FROM orders"""
       .replace("u_order-status", '"u_order-status"').replace("u-priority", '"u-priority"'))
def _(spark, d):
    raw = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return clean_column_names(raw.toDF("Order Key #1", "_Order-Status", "-(Priority)"))


@query("rename_score_columns", f"""WITH {META} SELECT CAST(n + 1 AS INTEGER) AS position, '1637_' || n || '_@SCORE' AS heading, var_name, major, item_type, round, item_id FROM meta""")
def _(spark, d):
    scored = A.drop_non_score_columns(wide(spark, d))
    headings = A.item_headings(scored)
    first = [c for c in scored.columns].index("1637_1_@SCORE")
    out = A.rename_score_columns(headings, items(spark, d))
    return out.withColumn("position", F.col("position") - F.lit(first - 2))


@query("rename_demographic_columns", f"""WITH {WIDE} SELECT "A_RowId" AS "ARowId", "182025_1_response_0" AS {STATUS}, "182025_2_response_0" AS {PRIORITY} FROM wide
WHERE "A_Final_Status" = 'TSICompleted'""".replace('AS "ARowId"', 'AS "A_RowId"'))
def _(spark, d):
    return demographics(spark, d)


@query("rename_prefix", 'SELECT o_orderkey AS "1279838_orderkey", o_orderstatus AS "1279838_orderstatus", o_totalprice AS x_totalprice FROM orders')
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("x_totalprice"))
    return A.rename_prefix(orders, "o_", "1279838_")


@query("coalesce_column_pairs", """SELECT o_orderkey AS "A_RowId", CASE WHEN o_orderstatus = 'F' THEN 'kept' ELSE o_orderpriority END AS "1637_a", o_orderstatus AS "1637_b" FROM orders""")
def _(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("A_RowId"),
        F.when(F.col("o_orderstatus") == "F", "kept").alias("1637_a"),
        F.col("o_orderstatus").alias("1637_b"),
        F.col("o_orderpriority").alias("1279838_a"),
    )
    return A.coalesce_column_pairs(orders)


OPTIONS = "opt AS (SELECT o_orderpriority AS option_id, 'code ' || lower(min(substr(o_orderpriority, 3))) AS code FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)"


def options(spark, d):
    known = table(spark, d, "orders").where("o_orderpriority <> '5-LOW'").groupBy(F.col("o_orderpriority").alias("option_id"))
    return known.agg(F.concat(F.lit("code "), F.lower(F.min(F.expr("substring(o_orderpriority, 3)")))).alias("code"))


CODED = f"""{OPTIONS}, dem AS (SELECT "A_RowId", "182025_1_response_0" || '_unknown' AS {STATUS}, coalesce(code, "182025_2_response_0" || '_unknown') AS {PRIORITY}
  FROM wide LEFT JOIN opt ON option_id = "182025_2_response_0" WHERE "A_Final_Status" = 'TSICompleted')"""


@query("code_lookup", f"WITH {WIDE}, {CODED} SELECT * FROM dem")
def _(spark, d):
    return A.code_lookup(demographics(spark, d), options(spark, d))


@query("row_average", f"WITH {AVERAGES} SELECT \"A_RowId\", round, round(average, 6) AS average FROM av")
def _(spark, d):
    return A.row_average(answers(spark, d)).withColumn("average", F.round("average", 6))


DEVIATION = 'SELECT "A_RowId", round, item, round(average, 6) AS average, round(deviation, 6) AS deviation FROM dev'


@query("deviation_from_row_average", f"WITH {AVERAGES} {DEVIATION}")
def _(spark, d):
    out = A.deviation_from_row_average(answers(spark, d))
    return out.withColumn("average", F.round("average", 6)).withColumn("deviation", F.round("deviation", 6))


@query("udf_deviation", f"WITH {AVERAGES} SELECT item, round(sum(deviation), 4) AS total FROM dev GROUP BY item")
def _(spark, d):
    out = A.deviation_from_row_average(answers(spark, d))
    return out.groupBy("item").agg(F.round(F.sum("deviation"), 4).alias("total"))


@query("weighted_scores", f'WITH {TOP} SELECT "A_RowId", subject, score FROM sc')
def _(spark, d):
    return A.weighted_scores(answers(spark, d))


@query("top_choice", f"WITH {TOP} SELECT * FROM choice")
def _(spark, d):
    return A.top_choice(A.weighted_scores(answers(spark, d)))


ROUNDS = [1, 3, 5, 7]
JOINED = """rounds AS (SELECT "A_RowId", {means}, {values} FROM dev GROUP BY "A_RowId")""".format(
    means=", ".join(f'round(max(CASE WHEN round = {r} THEN average END), 6) AS "Average{r}"' for r in A.ROUNDS),
    values=", ".join(f"round(max(CASE WHEN n = {n} THEN deviation END), 6) AS item{n}" for n in ROUNDS),
)


def _rounded_rounds(df, names):
    """Item columns under the item's number: their short names depend on the data."""
    means = [F.round(f"Average{r}", 6).alias(f"Average{r}") for r in A.ROUNDS]
    return [*means, *[F.round(F.col(name), 6).alias(f"item{n}") for n, name in names.items()]]


def _item_names(spark, d):
    item_map = A.rename_score_columns(A.item_headings(wide(spark, d)), items(spark, d))
    return {int(r["item_id"]): r["var_name"] for r in item_map.collect() if int(r["item_id"]) in ROUNDS}


@query("join_rounds", f"WITH {AVERAGES}, {JOINED} SELECT * FROM rounds")
def _(spark, d):
    names = _item_names(spark, d)
    out = A.join_rounds(A.deviation_from_row_average(answers(spark, d)), list(names.values()))
    return out.select("A_RowId", *_rounded_rounds(out, names))


@query("join_scores", f"""WITH {AVERAGES}, {JOINED}, {TOP.replace(LONG + ', ', '')}, {CODED}
SELECT rounds.*, {STATUS}, {PRIORITY}, final_choice, top_score FROM rounds JOIN dem ON rounds."A_RowId" = dem."A_RowId" JOIN choice ON choice."A_RowId" = dem."A_RowId" """)
def _(spark, d):
    names = _item_names(spark, d)
    long = answers(spark, d)
    rounds = A.join_rounds(A.deviation_from_row_average(long), list(names.values()))
    coded = A.code_lookup(demographics(spark, d), options(spark, d))
    out = A.join_scores(rounds, coded, A.top_choice(A.weighted_scores(long)))
    return out.select("A_RowId", *_rounded_rounds(out, names), STATUS, PRIORITY, "final_choice", "top_score")


@query("assessment_job", f"""WITH {AVERAGES}, {JOINED}, {TOP.replace(LONG + ', ', '')}, {CODED}
SELECT rounds.*, {STATUS}, {PRIORITY}, final_choice, top_score FROM rounds JOIN dem ON rounds."A_RowId" = dem."A_RowId" JOIN choice ON choice."A_RowId" = dem."A_RowId" """)
def _(spark, d):
    final, item_map = A.score_assessment(wide(spark, d), items(spark, d), HEADINGS, options(spark, d))
    names = {int(r["item_id"]): r["var_name"] for r in item_map.collect() if int(r["item_id"]) in ROUNDS}
    return final.select("A_RowId", *_rounded_rounds(final, names), STATUS, PRIORITY, "final_choice", "top_score")


@query("join_item_map", f"""WITH {META} SELECT p_partkey, p_name, var_name, meta.major, item_type, round FROM part JOIN meta ON p_partkey % 7 + 1 = n""")
def _(spark, d):
    parts = table(spark, d, "part").select((F.col("p_partkey") % 7 + 1).cast("string").alias("item_id"), "p_partkey", "p_name")
    item_map = A.rename_score_columns(A.item_headings(wide(spark, d)), items(spark, d))
    return A.join_item_map(parts, item_map, ["item_id", "position", "heading"])


@query("write_assessment_report", f"WITH {TOP} SELECT final_choice, CAST(count(*) AS VARCHAR) AS n FROM choice GROUP BY final_choice")
def _(spark, d):
    path = new_folder(spark, "report")
    best = A.top_choice(A.weighted_scores(answers(spark, d)))
    write_single_csv(best.groupBy("final_choice").agg(F.count("*").alias("n")), path)
    return select_by_name(read_assessment(spark, path).na.fill("", ["final_choice"]), lambda n: True)

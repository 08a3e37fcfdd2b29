"""Survey-style assessments: wide answer tables, their headings and scores.

Headings are metadata and are handled as names; answers are handled long, one
row per (respondent, item), so that every score is one group-by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import select_by_name
from termloom.operators.lookups import lookup_join
from termloom.scratch import publish, write_table

# Column names, marks and prefixes of the answer table.
ROW_ID = "A_RowId"
STATUS = "A_Final_Status"
COMPLETED = "TSICompleted"
DEMOGRAPHIC_PREFIX = "182025"
SCORE_MARK = "_@SCORE"
SHIFT_PREFIX, KEEP_PREFIX = "1279838_", "1637_"
NOT_DEMOGRAPHIC = ["SCORE", "startTime", "longresponse", "item_pool_id", "@itemId", "duration"]
NOT_SCORE = ["response", "startTime"]
DEMOGRAPHIC_NOISE = ["182025", "_0", "response", "_"]
MISSING = -9999.0
ANSWER_LIMIT = 4
FINAL_WEIGHT = 3
ROUNDS = (1, 2, 3)


def filter_complete(df: DataFrame) -> DataFrame:
    return df.where(F.col(STATUS) == COMPLETED)


def demographic_columns(df: DataFrame) -> DataFrame:
    def keep(name: str) -> bool:
        chosen = name.startswith(DEMOGRAPHIC_PREFIX) or "a_rowid" in name.lower()
        return chosen and not any(part in name for part in NOT_DEMOGRAPHIC)

    return select_by_name(df, keep)


def drop_non_score_columns(df: DataFrame) -> DataFrame:
    return select_by_name(
        df, lambda n: not n.startswith(DEMOGRAPHIC_PREFIX) and not any(part in n for part in NOT_SCORE)
    )


def columns_of_round(df: DataFrame, prefix: str) -> DataFrame:
    """The row id and the columns that start with a round's prefix."""
    return select_by_name(df, lambda n: n.startswith(prefix) or n.lower().startswith("a_row"))


def demographic_heading(name: str, headings: Mapping[str, str]) -> str:
    short = name
    for noise in DEMOGRAPHIC_NOISE:
        short = short.replace(noise, "")
    if short not in headings:
        return ROW_ID if "RowId" in short else short
    text = headings[short].lower().replace(" ", "").replace("?", "")
    return text[:17] if len(text) > 18 else text


def rename_demographic_columns(df: DataFrame, headings: Mapping[str, str]) -> DataFrame:
    return df.toDF(*[demographic_heading(c, headings) for c in df.columns])


def rename_prefix(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnsRenamed({c: new + c[len(old):] for c in df.columns if c.startswith(old)})


def coalesce_column_pairs(df: DataFrame, shift: str = SHIFT_PREFIX, keep: str = KEEP_PREFIX) -> DataFrame:
    """Fill nulls of one prefix from the twin under another, in one projection."""
    out = []
    for name in df.columns:
        twin = shift + name[len(keep):] if name.startswith(keep) else None
        if name.startswith(shift) and keep + name[len(shift):] in df.columns:
            continue
        out.append(F.coalesce(F.col(f"`{name}`"), F.col(f"`{twin}`")).alias(name) if twin in df.columns else F.col(f"`{name}`"))
    return df.select(*out)


def code_lookup(df: DataFrame, options: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Replace option ids (option_id, code) by their code in every column but the key."""
    table = write_table(options, "options")
    for name in [c for c in df.columns if c != key]:
        one = replace(table, table=table.table.select(F.col("option_id").alias(name), F.col("code").alias("_code")))
        unknown = F.concat(F.col(name), F.lit("_unknown"))
        joined = lookup_join(df, one, [name], "left")
        df = joined.withColumn(name, F.coalesce("_code", unknown)).select(*df.columns)
    return df


def item_headings(df: DataFrame) -> DataFrame:
    """(position, heading, item_id) of the score columns; as many rows as columns."""
    found = []
    for position, name in enumerate(df.columns):
        if SCORE_MARK in name.upper():
            full = name[: name.upper().index(SCORE_MARK)]
            found.append((position, name, full.rsplit("_", 1)[-1]))
    return df.sparkSession.createDataFrame(found, "position int, heading string, item_id string")


def rename_score_columns(headings: DataFrame, items: DataFrame) -> DataFrame:
    """Short names for score columns, and the item map.

    ``items`` is (item_id, item_type, major). A name is the item's kind, its
    round and an abbreviated subject, numbered 1, 2, 3… where names repeat.
    """
    joined = headings.join(items, "item_id", "left").na.fill("NA", ["item_type", "major"])
    at = F.instr("item_type", "R0")
    round_no = F.expr("substring(item_type, instr(item_type, 'R0') + 2, 1)")
    subject = F.when(F.length("major") < 5, F.col("major")).otherwise(
        F.concat(F.substring("major", 1, 3), F.expr("substring(major, -2, 2)"))
    )
    first = F.substring(F.substring_index("item_type", "_", -1), 1, 1)
    kind = F.when(F.upper(first) == "I", "f").otherwise(first)
    base = joined.where(at > 0).select(
        "position", "heading", "item_id", "item_type", "major", round_no.alias("round"),
        F.concat(kind, round_no, subject).alias("_base"),
    )
    turn = F.row_number().over(Window.partitionBy("_base").orderBy("position"))
    return base.select(
        "position", "heading", F.lower(F.concat("_base", turn.cast("string"))).alias("var_name"),
        "major", "item_type", "round", "item_id",
    )


def apply_names(df: DataFrame, item_map: DataFrame) -> DataFrame:
    """Rename the score columns and drop all others but the row id."""
    names = {r["heading"]: r["var_name"] for r in item_map.select("heading", "var_name").collect()}
    chosen = [c for c in df.columns if c in names or "RowId" in c]
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in chosen])


def long_answers(wide: DataFrame, key: str = ROW_ID) -> DataFrame:
    """(row id, item, value) with unreadable and missing answers left out."""
    names = [c for c in wide.columns if c != key]
    typed = wide.select(key, *[F.col(c).try_cast("double").alias(c) for c in names])
    return typed.unpivot([key], names, "item", "value").where("value is not null")


def row_average(answers: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Mean of a respondent's valid answers per round (second letter of the item)."""
    valid = (F.col("value") >= 0) & (F.col("value") < ANSWER_LIMIT)
    likert = answers.where(F.col("item").startswith("l"))
    mean = F.avg(F.when(valid, F.col("value")))
    return likert.groupBy(key, F.substring("item", 2, 1).cast("int").alias("round")).agg(
        F.coalesce(mean, F.lit(MISSING)).alias("average")
    )


def deviation_from_row_average(answers: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Answer less the respondent's own mean of the round; one plan for all rounds."""
    rounds = Window.partitionBy(key, "round")
    valid = (F.col("value") >= 0) & (F.col("value") < ANSWER_LIMIT)
    likert = answers.where(F.col("item").startswith("l")).withColumn("round", F.substring("item", 2, 1).cast("int"))
    mean = F.coalesce(F.avg(F.when(valid, F.col("value"))).over(rounds), F.lit(MISSING))
    shifted = F.when(F.col("value") >= 0, F.col("value") - F.col("average")).otherwise(MISSING)
    return likert.withColumn("average", mean).select(key, "round", "item", "average", shifted.alias("deviation"))


def join_rounds(deviations: DataFrame, items: Sequence[str], key: str = ROW_ID) -> DataFrame:
    """All rounds of a respondent side by side, as one conditional aggregate."""
    picked = [F.max(F.when(F.col("item") == i, F.col("deviation"))).alias(i) for i in items]
    means = [F.max(F.when(F.col("round") == r, F.col("average"))).alias(f"Average{r}") for r in ROUNDS]
    return deviations.groupBy(key).agg(*means, *picked)


def weighted_scores(answers: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Sum per (respondent, subject), items of the final kind counting three times."""
    subject = F.expr("substring(item, 3, length(item) - 3)")
    weight = F.when(F.col("item").startswith("f"), FINAL_WEIGHT).otherwise(1)
    return answers.groupBy(key, subject.alias("subject")).agg(F.sum(F.col("value") * weight).alias("score"))


def top_choice(scores: DataFrame, key: str = ROW_ID) -> DataFrame:
    """The subject with the greatest positive sum; ties go to the first name."""
    best = F.min(F.when(F.col("score") > 0, F.struct((-F.col("score")).alias("_n"), F.col("subject").alias("_s"))))
    return scores.groupBy(key).agg(best.alias("_b")).select(
        key,
        F.coalesce("_b._s", F.lit("")).alias("final_choice"),
        F.coalesce(-F.col("_b._n"), F.lit(0.0)).alias("top_score"),
    )


def join_scores(scores: DataFrame, demographics: DataFrame, choice: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Three tables with one row per respondent each."""
    return scores.join(demographics, key).join(choice, key)


def join_item_map(item_table: DataFrame, item_map: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    return item_table.join(item_map, "item_id").drop(*drop)


def score_assessment(
    wide: DataFrame, items: DataFrame, headings: Mapping[str, str], options: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The whole job: final table per respondent, and the item map."""
    complete = filter_complete(wide)
    demographics = code_lookup(rename_demographic_columns(demographic_columns(complete), headings), options)
    scored = drop_non_score_columns(complete)
    item_map = publish(rename_score_columns(item_headings(scored), items), "items")
    answers = apply_names(scored, item_map)
    long = long_answers(answers)
    names = [c for c in answers.columns if c.startswith("l")]
    deviations = join_rounds(deviation_from_row_average(long), names)
    choice = top_choice(weighted_scores(long))
    return join_scores(deviations, demographics, choice), item_map

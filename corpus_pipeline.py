"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and reread as the next one's ``docs``. All but the last return the columns of
``documents``; the last adds how many words of each document the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import table
from termloom.llm.decontaminate import decontaminate
from termloom.llm.mixing import mix_sources
from termloom.llm.neardup import drop_near_duplicates
from termloom.llm.substrings import remove_repeats
from termloom.llm.toxicity import fit_toxicity, score_toxicity
from termloom.scratch import publish

#: Documents that score at least this are rejected.
TOXIC = 0.5
#: Whole documents cross to Python in batches of so many rows, so that long texts stay small in memory.
BATCH_ROWS = "1000"


def use_small_batches(spark: SparkSession) -> None:
    """This job's own session setting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the factorization machine rejects."""
    use_small_batches(spark)
    machine = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, machine).filter(F.col("toxicity") < TOXIC).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: shingles of five words, similarity 0.8."""
    use_small_batches(spark)
    return drop_near_duplicates(docs, size=5, similarity=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 13 words and more that an earlier document has."""
    use_small_batches(spark)
    cut = remove_repeats(docs, size=13)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    use_small_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words to take of each document so that sources meet their targets."""
    use_small_batches(spark)
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Fitting, fingerprints and automata cannot be written in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = publish(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A bounded sample of labelled documents to fit a classifier on.

Labels come from a table of their own; texts are met by a broadcast of the
sampled ids only, whose number is bounded by a parameter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import as_bytes


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, bound: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, float]:
    """(id, y, body) of at most ``bound`` labelled ids, and the odds of label 1 among all labels learned from.

    Of either label the first ``bound // 2`` ids by hash are taken, so a rare
    label is seen as often as can be; the odds let a model undo that.
    ``learn_from`` says on the labels' own columns which rows may be learned
    from. Null ids and null labels teach nothing; of repeated labels the largest
    counts; a document that stands twice is met twice.
    """
    usable = labels.filter(learn_from & F.col(id_col).isNotNull() & F.col(label).isNotNull())
    one = usable.groupBy(F.col(id_col).alias("id")).agg((F.max(F.col(label)) > 0).cast("int").alias("y"))
    total = one.agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
    ones, zeros = total["p"] or 0, total["n"] - (total["p"] or 0)
    first = [one.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(bound // 2) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("body"))
    return texts.join(F.broadcast(first[0].unionAll(first[1])), "id"), (ones + 0.5) / (zeros + 0.5)


def log_odds_shift(labels: np.ndarray, odds: float) -> float:
    """What to add to raw scores learned on ``labels`` so that they fit the given odds of label 1."""
    ones = float(labels.sum())
    return float(np.log(odds) - np.log((ones + 0.5) / (len(labels) - ones + 0.5)))

"""Small hand-written cases for the decisions on ambiguous behaviour."""

import math

import pytest
from pyspark.sql import functions as F

from termloom.operators import columns as C
from termloom.operators import rows as R
from termloom.operators import scale as S
from termloom.operators import targets as T
from termloom.plans.steps import by_target, run_steps
from tests.conftest import frame_of


def cells(frame):
    return {(r["row_id"], r["term"]): r["value"] for r in frame.cells.collect()}


def test_empty_rows_count_in_denominators(small):
    shares = {r["term"]: r["proportion"] for r in C.column_proportion(small).collect()}
    assert shares == {"x": 0.5, "y": 0.5, "z": 0.25}


def test_stddev_counts_absent_cells_as_zero(small):
    got = {r["term"]: r["stddev"] for r in C.column_stddevs(small).collect()}
    assert got["z"] == pytest.approx(math.sqrt(25 / 4 - (5 / 4) ** 2))


def test_low_frequency_keeps_terms_at_the_median(small):
    assert {r["term"] for r in C.remove_low_frequency(small).cells.collect()} == {"y", "z"}


def test_low_percentile_zero_is_no_op(small):
    assert C.remove_low_frequency_percentile(small, 0) is small


def test_tfidf_by_hand(small):
    got = cells(S.tfidf(small))
    assert got[("r1", "y")] == pytest.approx(0.75 * math.log(4 / 2))
    assert got[("r3", "z")] == pytest.approx(0.5 * math.log(4 / 1))


def test_by_target_equals_each_label_alone(small):
    whole = cells(run_steps(small, [by_target(S.tfidf)]))
    apart = {}
    for label in ("A", "B"):
        apart.update(cells(S.tfidf(T.subset_by_target(small, label))))
    assert whole == pytest.approx(apart)


def test_absent_data_passes_through():
    assert run_steps(None, [lambda f: f.missing]) is None


def test_normalize_rows_then_columns(small):
    by_term = {}
    for (_, term), value in cells(S.normalize_rows_then_columns(small)).items():
        by_term[term] = by_term.get(term, 0) + value
    assert by_term == pytest.approx({"x": 1, "y": 1, "z": 1})


def test_long_and_short_row_scaling_agree(small):
    assert cells(S.normalize_long_rows(small)) == pytest.approx(cells(S.normalize_rows(small)))


def test_two_targets_collapse_ties(spark):
    rows = [(f"r{i}", t) for i, t in enumerate("a" + "bb" + "cc" + "ddd" + "eeee" + "fffff")]
    frame = frame_of(spark, [(r, t, "x", 1.0) for r, t in rows], rows)
    got = [(r["target"], r["n_rows"]) for r in T.two_targets_above_median(frame).orderBy("n_rows").collect()]
    assert got == [("e", 4), ("f", 5)]  # distinct counts 1 2 3 4 5, upper median 3


def test_balance_cuts_to_the_upper_median(spark):
    rows = [(f"r{i}", t) for i, t in enumerate("a" * 2 + "b" * 5 + "c" * 40)]
    frame = frame_of(spark, [(r, t, "x", 1.0) for r, t in rows], rows)
    counts = {r["target"]: r["n_rows"] for r in T.count_by_target(T.balance_targets(frame).rows).collect()}
    assert counts == {"a": 2, "b": 5, "c": 5}


def test_trim_names_are_case_sensitive(spark):
    names = ["BLANK x", "RELIGION", "religion", "any subject", "blank"]
    frame = frame_of(spark, [(f"r{i}", t, "x", 1.0) for i, t in enumerate(names)])
    left = {r["target"] for r in T.trim_targets(frame, 1).rows.collect()}
    assert left == {"religion", "blank"}


def test_duplicates(spark):
    body = [("x", 1.0), ("y", 2.0)]
    data = [(f"r{i}", "A", t, v) for i in range(3) for t, v in body] + [("r9", "A", "x", 1.0), ("s1", "B", "x", 1.0), ("s1", "B", "y", 2.0)]
    frame = frame_of(spark, data)
    found = R.analyze_duplicates(frame).collect()
    assert [(r["target"], r["copies"], r["share"]) for r in found] == [("A", 3, 0.75)]
    assert {r["row_id"] for r in R.distinct_rows(frame).rows.collect()} == {"r0", "r9", "s1"}
    assert {r["row_id"] for r in R.remove_overrepresented_duplicates(frame, 0.5).rows.collect()} == {"r9", "s1"}
    assert R.remove_overrepresented_duplicates(frame, 0.75).rows.count() == 5


def test_hash_ignores_row_id_and_cell_order(spark):
    one = frame_of(spark, [("a", "T", "x", 1.0), ("a", "T", "y", 2.0)])
    two = frame_of(spark, [("b", "T", "y", 2.0), ("b", "T", "x", 1.0)])
    assert R.row_hashes(one).first()["row_hash"] == R.row_hashes(two).first()["row_hash"]


def test_random_subset_rows_and_cells_agree(small):
    part = R.random_subset(small, 0.5, 3)
    ids = {r["row_id"] for r in part.rows.collect()}
    assert {r["row_id"] for r in part.cells.collect()} <= ids


def test_wide_and_long_reductions_agree(small):
    """The same reduction on the wide and on the long form."""
    wide = S.dense_pivot(small, ["x", "y", "z"])
    sums = C.wide_sums(wide, ["x", "y", "z"]).first().asDict()
    assert sums == {r["term"]: r["total"] for r in C.column_sums(small.cells).collect()}
    kept = set(C.drop_below_median(wide, ["x", "y", "z"]).columns) - {"row_id", "target"}
    assert kept == {r["term"] for r in C.remove_low_frequency(small).cells.select("term").distinct().collect()}


def test_dense_to_sparse_label_order(spark):
    wide = spark.createDataFrame([("1", "b", 1, 0), ("2", "b", 0, 4), ("3", "a", 0, 0)], "id string, t string, x int, y int")
    frame = S.dense_to_sparse(wide, "id", "t", ["x", "y"])
    assert cells(frame) == {("1", "x"): 1.0, ("2", "y"): 4.0}
    assert {r["target"]: r["idx"] for r in frame.targets.collect()} == {"b": 0.0, "a": 1.0}


def test_merge_needs_both_labels(spark):
    frame = frame_of(spark, [("1", "#old name", "x", 1.0), ("2", "#new", "x", 1.0), ("3", "#solo", "x", 1.0)])
    pairs = spark.createDataFrame([("OLD_NAME", "NEW"), ("SOLO", "MISSING")], "old string, new string")
    got = {r["row_id"]: r["target"] for r in T.merge_targets(frame, pairs).rows.collect()}
    assert got == {"1": "#new", "2": "#new", "3": "#solo"}


def test_stop_words_ignore_case_and_unknown(small):
    left = C.remove_stop_words(small, " X ,nope").cells.select("term").distinct()
    assert {r["term"] for r in left.collect()} == {"y", "z"}


def test_exact_sample_is_exact(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert R.exact_sample(df, "k", 137, "s").count() == 137


def test_texts_are_dealt_by_their_size(spark, monkeypatch):
    """A task's part of the texts keeps its size when there are more of them, whatever the number of shuffle partitions."""
    from termloom import frame

    monkeypatch.setattr(frame, "TEXT_PART", 50)
    texts = spark.range(400).selectExpr("id", "'a' AS label", "concat('some words of text ', id) AS body")
    cells = frame.text_frame(texts, "id", "label", "body").cells
    assert cells.select(F.spark_partition_id()).distinct().count() > 50
    assert cells.count() == 3 * 400

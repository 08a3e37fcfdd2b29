"""Ready-made runs. Each returns the frames it outputs, by stage name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from termloom.frame import SparseFrame
from termloom.operators.clusters import CycleSettings, cycle_by_target, kmeans_trim_cycle, lda_trim_cycle, second_tier_clusters
from termloom.operators.columns import remove_high_frequency, remove_low_frequency, remove_low_frequency_percentile
from termloom.operators.phrases import attach_supplement, last_iteration_terms, term_pair_sentences, term_pairs, top_terms_per_cluster
from termloom.operators.rows import duplicate_analysis
from termloom.operators.targets import merge_targets, trim_targets
from termloom.plans.steps import Step, materialise, run_steps, run_table_steps, tfidf_by_target
from termloom.sources.store import Store, append_supplement, create_supplement
from termloom.sources.tables import pivot_codes, read_coded_sentences, supplement_by_label

CODES_STORE = "competencycodes"


def _per_label_tfidf(frame: SparseFrame, steps: Sequence[Step]) -> dict[str, SparseFrame]:
    """Reduce, then per label the counts and their tf-idf."""
    counts = run_steps(frame.materialise(), [*steps, materialise])
    return {"counts": counts, "tfidf": tfidf_by_target(counts)}


def documents(frame: SparseFrame, high: float = 99, low: float = 75, min_rows: int = 100) -> dict[str, SparseFrame]:
    steps = [
        lambda f: remove_high_frequency(f, high),
        lambda f: remove_low_frequency_percentile(f, low),
        lambda f: trim_targets(f, min_rows),
        duplicate_analysis,
    ]
    return _per_label_tfidf(frame, steps)


def sentences(
    frame: SparseFrame, merge_map: DataFrame, high: float = 99, low: float = 0, min_rows: int = 1500
) -> dict[str, SparseFrame]:
    steps = [
        lambda f: remove_high_frequency(f, high),
        lambda f: remove_low_frequency_percentile(f, low),
        lambda f: merge_targets(f, merge_map),
        lambda f: trim_targets(f, min_rows),
        duplicate_analysis,
    ]
    return _per_label_tfidf(frame, steps)


def posts(frame: SparseFrame, high: float = 99) -> dict[str, SparseFrame]:
    """The same steps serve whole posts and their sentences."""
    return _per_label_tfidf(frame, [lambda f: remove_high_frequency(f, high), duplicate_analysis])


def trim_only(frame: SparseFrame, min_rows: int = 1000) -> dict[str, SparseFrame]:
    trimmed = trim_targets(frame, min_rows)
    return {"trimmed": trimmed, "by_label": trimmed}


def _phrase_input(frame: SparseFrame, merge_map: DataFrame, min_rows: int, high: float, low_offset: float) -> SparseFrame:
    return run_steps(
        frame.materialise(),
        [
            lambda f: merge_targets(f, merge_map),
            lambda f: trim_targets(f, min_rows),
            duplicate_analysis,
            lambda f: remove_high_frequency(f, high),
            lambda f: remove_low_frequency(f, low_offset),
            materialise,
        ],
    )


def _mine(frame: SparseFrame, clusters: DataFrame, top_terms: int) -> DataFrame:
    top = top_terms_per_cluster(last_iteration_terms(clusters), top_terms)
    return term_pair_sentences(frame.cells, term_pairs(top))


def phrases_kmeans(
    frame: SparseFrame,
    merge_map: DataFrame,
    supplement: DataFrame,
    settings: CycleSettings,
    min_rows: int = 750,
    high: float = 99.5,
    top_terms: int = 5,
) -> dict[str, DataFrame]:
    """Phrases from clusters of all rows, per label, and of a second tier."""
    data = _phrase_input(frame, merge_map, min_rows, high, 0.0)
    whole = _mine(data, kmeans_trim_cycle(data, settings), top_terms)
    labelled = _mine(data, cycle_by_target(data, "kmeans", settings), top_terms)
    return {
        "phrases": attach_supplement(whole, supplement),
        "phrases_by_target": attach_supplement(labelled, supplement),
        "second_tier": second_tier_clusters(data, whole),
    }


def phrases_lda(
    frame: SparseFrame,
    merge_map: DataFrame,
    supplement: DataFrame,
    settings: CycleSettings,
    min_rows: int = 1000,
    high: float = 99.5,
    top_terms: int = 5,
) -> dict[str, DataFrame]:
    data = _phrase_input(frame, merge_map, min_rows, high, 0.0)
    whole = _mine(data, lda_trim_cycle(data, settings), top_terms)
    labelled = _mine(data, cycle_by_target(data, "lda", settings), top_terms)
    return {
        "phrases": attach_supplement(whole, supplement),
        "phrases_by_target": attach_supplement(labelled, supplement),
    }


def phrase_coding(raw: DataFrame, codes: Sequence[str], store: Store, batch_id: str, now) -> DataFrame:
    """Load human codes, widen them, and append them to the codes store."""
    coded, _ = read_coded_sentences(raw)
    wide = pivot_codes(coded, codes)
    table = wide.withColumnRenamed("label_id", "aa_label").withColumnRenamed("label_name", "aa_label_name")
    table = table.select(*[table[c].cast("string").alias(c) for c in table.columns])
    create_supplement(store, table)
    append_supplement(store, table, batch_id, now)
    return wide


def supplement_output(supplement: DataFrame, labels: DataFrame) -> DataFrame:
    """The stored supplement, one copy of a row per matching label."""
    return run_table_steps(supplement, [lambda df: supplement_by_label(df, labels)])

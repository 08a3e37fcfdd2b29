"""Runs of ordered steps. A step is a function from sparse frame to sparse frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame

from termloom.frame import SparseFrame
from termloom.operators import columns, scale

Step = Callable[[SparseFrame], SparseFrame]
TableStep = Callable[[DataFrame], DataFrame]
BY_TARGET = ("target",)


def run_steps(frame: SparseFrame | None, steps: Sequence[Step]) -> SparseFrame | None:
    """Hand each step's output to the next; absent data passes through."""
    return reduce(lambda data, step: None if data is None else step(data), steps, frame)


def run_table_steps(table: DataFrame, steps: Sequence[TableStep]) -> DataFrame:
    return reduce(lambda data, step: data.transform(step), steps, table)


def by_target(step: Callable[..., SparseFrame], *args, **kwargs) -> Step:
    """A step computed for each label apart, in one plan for all labels."""

    def run(frame: SparseFrame) -> SparseFrame:
        return step(frame, *args, by=BY_TARGET, **kwargs)

    return run


def run_by_target(frame: SparseFrame, steps: Sequence[Callable[..., SparseFrame]]) -> SparseFrame:
    """Run steps that take ``by`` on every label's subset at once."""
    return reduce(lambda data, step: step(data, by=BY_TARGET), steps, frame)


def materialise(frame: SparseFrame) -> SparseFrame:
    """A step that writes rows and cells once, before steps that read them often."""
    return frame.materialise()


tfidf_by_target: Step = partial(scale.tfidf, by=BY_TARGET)
remove_low_frequency_by_target: Step = partial(columns.remove_low_frequency, by=BY_TARGET)

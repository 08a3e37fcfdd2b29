"""Quality by logistic regression over hashed word n-grams, learned with FTRL.

Features are n-grams of words and, beside them, n-grams of word shapes, hashed to
a fixed number of slots. A shape keeps the case, digits and marks of a word, and says
whether the word repeats the one before, so a habit seen with one word (all
capitals, trailing symbols, stuttering) carries over to words never seen.
Weights are updated by follow-the-regularised-leader, which leaves most of them
at exactly zero; a score is a sparse dot product over the others.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import Memo, as_bytes, map_batches
from termloom.llm.labelled import labelled_sample, log_odds_shift

RUNS = re.compile(rb"(.)\1+", re.S)
#: Letters in capitals, small letters and non-ASCII bytes, and digits by class; marks as they are.
CLASSES = bytes(
    0x58 if 0x41 <= c <= 0x5A else 0x78 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x39 if 0x30 <= c <= 0x39 else c
    for c in range(256)
)
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class FTRLParams:
    sample: int = 8_000  #: labelled documents learned from, at most
    bits: int = 20  #: 2**bits slots
    grams: int = 3  #: longest n-gram of words and of shapes
    scale: float = 4.0  #: value of an n-gram that starts at every word
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05
    seed: int = 11


def word_codes(word: bytes) -> int:
    """Hash of the word in lower case (high half) and of its shape (low half)."""
    return zlib.crc32(word.lower()) << 32 | zlib.crc32(RUNS.sub(rb"\1", word.translate(CLASSES)))


class Features:
    """Slots of all n-grams of a text; made once per task."""

    def __init__(self, params: FTRLParams):
        self.params, self.codes = params, Memo(word_codes)

    def slots(self, h: np.ndarray) -> np.ndarray:
        return ((h * MIX) >> np.uint64(64 - self.params.bits)).astype(np.int64)

    def grams(self, body: bytes) -> tuple[np.ndarray, int]:
        """The slot of each occurrence of an n-gram, and the number of words."""
        words = body.split()
        if not words:
            return np.zeros(0, dtype=np.int64), 0
        codes = np.fromiter(map(self.codes.__getitem__, words), dtype=np.uint64, count=len(words))
        word, gram = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
        gram <<= np.uint64(1)
        gram[1:] |= word[1:] == word[:-1]
        groups = []
        for kind, single in enumerate((word, gram)):
            several = single
            for n in range(1, min(self.params.grams, len(words)) + 1):
                several = single if n == 1 else several[:-1] * MIX + single[n - 1 :]
                groups.append(several + np.uint64(n << 40 + 10 * kind))
        return self.slots(np.concatenate(groups)), len(words)

    def of(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct slots and their values: a constant at slot 0, and occurrences per word."""
        slots, n = self.grams(body)
        ids, counts = np.unique(np.append(slots, 0), return_counts=True)
        values = counts * (self.params.scale / max(n, 1))
        values[0] = 1.0 + (counts[0] - 1) * (self.params.scale / max(n, 1))
        return ids, values


@dataclass
class Ftrl:
    """The learned weights; most are zero."""

    params: FTRLParams
    weight: np.ndarray
    shift: float = 0.0  #: added to raw scores

    @classmethod
    def fit(cls, params: FTRLParams, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Ftrl:
        """One update per document; the same input gives the same weights."""
        size = 1 << params.bits
        z, n = np.zeros(size), np.zeros(size)
        rng = np.random.default_rng(params.seed)

        def weights(ids: np.ndarray) -> np.ndarray:
            zi = z[ids]
            w = -(zi - np.sign(zi) * params.l1) / ((params.beta + np.sqrt(n[ids])) / params.alpha + params.l2)
            return np.where(np.abs(zi) <= params.l1, 0.0, w)

        for _ in range(params.epochs):
            for i in rng.permutation(len(docs)):
                ids, x = docs[i][0], docs[i][1].astype(float)
                w = weights(ids)
                g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i]) * x
                z[ids] += g - (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / params.alpha * w
                n[ids] += g * g
        return cls(params, weights(np.arange(size)).astype(np.float32))

    def scorer(self):
        features = Features(self.params)

        def score(body: bytes) -> float:
            slots, n = features.grams(body)
            raw = self.shift + float(self.weight[0]) + float(self.weight[slots].sum()) * self.params.scale / max(n, 1)
            return 1 / (1 + math.exp(-min(max(raw, -35.0), 35.0)))

        return score


def list_views(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of an Arrow column as views into its buffers: a sample stands in memory once."""
    views = []
    for chunk in column.chunks:
        flat, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        views += [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return views


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column | None = None,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    params: FTRLParams | None = None,
) -> Ftrl:
    """Fit on at most ``params.sample`` labelled documents; without any, all scores are 0.5."""
    params = params or FTRLParams()
    sample, odds = labelled_sample(docs, labels, label, F.lit(True) if learn_from is None else learn_from, params.sample, id_col, text_col)

    def make():
        features = Features(params)

        def work(rows: dict) -> dict:
            made = [features.of(body) for body in rows["body"]]
            return {"id": rows["id"], "y": rows["y"], "slots": [m[0] for m in made], "values": [m[1] for m in made]}

        return work

    kind = dict(sample.dtypes)["id"]
    made = map_batches(sample.select("id", "y", "body"), f"id {kind}, y int, slots array<int>, values array<float>", make)
    rows = made.dropDuplicates(["id"]).toArrow()  # at most params.sample
    order = pc.sort_indices(rows["id"]).to_numpy()
    slots, values = list_views(rows["slots"]), list_views(rows["values"])
    pairs = [(slots[i], values[i]) for i in order]
    truth = rows["y"].to_numpy().astype(float)[order]
    model = Ftrl.fit(params, pairs, truth)
    model.shift = log_odds_shift(truth, odds) if len(truth) else 0.0
    return model


def score_quality(docs: DataFrame, model: Ftrl, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, quality_score) of each row, repeated rows too, by the text alone.

    A null or empty text gets the score of the constant.
    """
    source = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("body"))

    def make():
        score = model.scorer()

        def work(rows: dict) -> dict:
            return {"id": rows["id"], "score": [score(b) for b in rows["body"]]}

        return work

    kind = dict(source.dtypes)["id"]
    return map_batches(source, f"id {kind}, score double", make).withColumnsRenamed({"id": id_col, "score": "quality_score"})

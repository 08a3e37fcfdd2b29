"""Toxicity by a factorization machine over hashed terms.

A term is a word or the head of a word (its first 4, 5 or 6 bytes), hashed to a
fixed number of slots. Spark screens the slots of a bounded labelled sample by
chi-square; the machine learns weights and pairwise interactions of the slots
that stay, so an insult beside a group mention may weigh more than both alone.
The model has a fixed size. Scoring is one pass over all documents.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termloom.llm.common import SLICE_ROWS, Memo, as_bytes, map_batches
from termloom.llm.labelled import labelled_sample, log_odds_shift
from termloom.scratch import publish

#: Word bytes: digits, letters in lower case and all non-ASCII bytes; the rest cuts words.
TERM_BYTES = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


@dataclass(frozen=True)
class FMParams:
    sample: int = 12_000  #: labelled documents learned from, at most
    slots: int = 1 << 20  #: hash slots of terms
    kept: int = 1_024  #: slots that stay after the screening
    heads: tuple[int, ...] = (4, 5, 6)  #: bytes of a word's head
    min_docs: int = 3  #: documents of the sample that a slot must occur in
    factors: int = 8
    epochs: int = 12
    batch: int = 64
    rate: float = 0.1
    decay: float = 2e-4
    seed: int = 7


def word_slots(word: bytes, params: FMParams) -> tuple[int, ...]:
    """The slots of a word and of its heads; a head of n bytes is hashed with n as the seed."""
    size, n = params.slots, len(word)
    return (zlib.crc32(word) % size, *[zlib.crc32(word[:h], h) % size for h in params.heads if n >= h])


@dataclass
class FactorizationMachine:
    """w0 + Σ w_i + Σ_{i<j} <v_i, v_j> over the slots that occur in a document."""

    params: FMParams
    slots: np.ndarray
    bias: float = 0.0
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factor: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def raw(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores of documents whose slot numbers stand one after the other, and the factor sums.

        Every document must hold at least one entry; the last slot number is a
        blank whose weights stay zero.
        """
        v = self.factor[ids]
        sums = np.add.reduceat(v, starts, axis=0)
        squares = np.add.reduceat((v * v).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.weight[ids], starts) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def fit(self, docs: list[np.ndarray], labels: np.ndarray) -> FactorizationMachine:
        """AdaGrad on the logistic loss; the same input gives the same model."""
        p, n = self.params, len(self.slots)
        rng = np.random.default_rng(p.seed)
        self.weight = np.zeros(n + 1)
        self.factor = np.vstack([rng.normal(0, 0.02, (n, p.factors)), np.zeros((1, p.factors))])
        rate = min(max(labels.mean(), 1e-3), 1 - 1e-3) if len(labels) else 0.5
        self.bias = float(np.log(rate / (1 - rate)))
        docs = [np.append(d, n) for d in docs]
        seen_w, seen_v, seen_b = np.full(n + 1, 1e-2), np.full((n + 1, p.factors), 1e-2), 1e-2
        for _ in range(p.epochs):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), p.batch):
                part = order[at : at + p.batch]
                sizes = np.array([len(docs[i]) for i in part])
                ids = np.concatenate([docs[i] for i in part])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                raw, sums = self.raw(ids, starts)
                slope = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - labels[part]) / len(part)
                each = np.repeat(slope, sizes)
                by_slot = np.argsort(ids, kind="stable")
                touched, first = np.unique(ids[by_slot], return_index=True)
                dw = np.add.reduceat(each[by_slot], first)
                dv = np.add.reduceat((each[:, None] * (np.repeat(sums, sizes, axis=0) - self.factor[ids]))[by_slot], first)
                dw += p.decay * self.weight[touched]
                dv += p.decay * self.factor[touched]
                real = touched < n
                dw, dv = dw * real, dv * real[:, None]
                seen_w[touched] += dw * dw
                seen_v[touched] += dv * dv
                seen_b += slope.sum() ** 2
                self.weight[touched] -= p.rate * dw / np.sqrt(seen_w[touched])
                self.factor[touched] -= p.rate * dv / np.sqrt(seen_v[touched])
                self.bias -= p.rate * slope.sum() / np.sqrt(seen_b)
        return self

    def scorer(self):
        """A function from texts to scores between 0 and 1."""
        number = {int(s): i for i, s in enumerate(self.slots)}
        known = Memo(lambda w: tuple(number[s] for s in word_slots(w, self.params) if s in number))
        blank = len(self.slots)

        def score(bodies: list[bytes]) -> np.ndarray:
            docs = []
            for body in bodies:
                words = set(body.translate(TERM_BYTES).split())
                docs.append(sorted({blank}.union(*filter(None, map(known.__getitem__, words)))))
            starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])[:-1]])
            raw, _ = self.raw(np.concatenate([np.array(d, dtype=np.int64) for d in docs]), starts.astype(np.int64))
            return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))

        return score


def sample_slots(sample: DataFrame, params: FMParams) -> DataFrame:
    """(id, y, slots) of the sampled documents; a document that stands twice once."""

    def make():
        known = Memo(lambda w: word_slots(w, params))

        def work(rows: dict) -> dict:
            words = [set(body.translate(TERM_BYTES).split()) for body in rows["body"]]
            slots = [np.fromiter(set().union(*map(known.__getitem__, w)), dtype=np.int32) for w in words]
            return {"id": rows["id"], "y": rows["y"], "slots": slots}

        return work

    kind = dict(sample.dtypes)["id"]
    return map_batches(sample.select("id", "y", "body"), f"id {kind}, y int, slots array<int>", make).dropDuplicates(["id"])


def screen(slots: DataFrame, params: FMParams) -> DataFrame:
    """The ``kept`` slots whose presence says most about the label, by chi-square."""
    totals = slots.agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
    n, p = float(totals["n"]), float(totals["p"] or 0)
    counts = slots.select("y", F.explode("slots").alias("slot")).groupBy("slot").agg(
        F.count("*").cast("double").alias("df"), F.sum("y").cast("double").alias("pos")
    )
    expected = F.col("df") * F.lit(p / n if n else 0.0)
    spread = F.lit(p / n * (1 - p / n) if n else 0.0) * F.col("df") * F.greatest(F.lit(n) - F.col("df"), F.lit(1.0)) / F.lit(max(n, 1.0))
    gain = F.when(spread > 0, (F.col("pos") - expected) * (F.col("pos") - expected) / spread).otherwise(F.lit(0.0))
    usable = counts.filter(F.col("df") >= params.min_docs)
    return usable.orderBy(gain.desc(), "slot").limit(params.kept).select("slot")


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column | None = None,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    params: FMParams | None = None,
) -> FactorizationMachine:
    """Fit on at most ``params.sample`` labelled documents; without any, all scores are 0.5."""
    params = params or FMParams()
    sample, odds = labelled_sample(docs, labels, label, F.lit(True) if learn_from is None else learn_from, params.sample, id_col, text_col)
    slots = publish(sample_slots(sample, params), "toxicity")
    kept = sorted(r["slot"] for r in screen(slots, params).collect())  # at most params.kept
    only = F.array_intersect("slots", F.lit(kept).cast("array<int>")) if kept else F.array().cast("array<int>")
    rows = slots.select("id", "y", only.alias("slots")).orderBy("id").toPandas()  # at most params.sample
    number = {s: i for i, s in enumerate(kept)}
    machine = FactorizationMachine(params, np.array(kept, dtype=np.int64))
    if rows.empty:
        machine.weight, machine.factor = np.zeros(len(kept) + 1), np.zeros((len(kept) + 1, params.factors))
        return machine
    truth = rows["y"].to_numpy(dtype=float)
    machine.fit([np.array([number[s] for s in d], dtype=np.int64) for d in rows["slots"]], truth)
    machine.bias += log_odds_shift(truth, odds)
    return machine


def score_toxicity(docs: DataFrame, machine: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``toxicity`` (0 to 1), by the text alone.

    Null and empty texts get the score of a text without known terms; rows are
    kept as they are, repeated ones too. A column named ``toxicity`` is replaced.
    """
    own = docs.drop("toxicity")
    names = own.columns
    if machine.params.slots <= 0:
        raise ValueError("slots must be positive")
    packed = own.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), as_bytes(text_col).alias("body"))

    result = T.StructType([packed.schema["row"], T.StructField("toxicity", T.DoubleType())])
    arrow = to_arrow_schema(result)

    def run(batches):
        score = machine.scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                scores = pa.array(score(part.column("body").to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("row").cast(arrow.field("row").type), scores], schema=arrow)

    return packed.mapInArrow(run, result).select("row.*", "toxicity")

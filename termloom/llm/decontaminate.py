"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel distance.

An item with a budget of k edits is cut into k+1 pieces; a passage within the
budget holds one of them unchanged. One automaton finds the pieces, and each
place is verified by the edit distance of the whole item to the best part of
the text around it. Items are taken in shards of bounded size, one pass over
the documents per shard (one shard for any usual benchmark); no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import SLICE_ROWS, as_bytes, map_batches
from termloom.scratch import publish

#: One edit is allowed for so many characters of an item.
CHARS_PER_EDIT = 20
#: Bytes of item texts in one shard, about.
SHARD_BYTES = 8_000_000


def normal(body: bytes) -> str:
    """A-Z in lower case, words joined by one blank."""
    return b" ".join(body.lower().split()).decode("utf-8", "replace")


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end) of the part of ``text`` nearest to ``pattern``; the first end of several."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    plus, minus, score, best = full, 0, m, (m, 0)
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score < best[0]:
            best = (score, at)
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(xv | up) & full
        minus = up & xv
    return best


class Matcher:
    """Compiled items; made once per task."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int):
        self.items = [(i, t, len(t) // chars_per_edit) for i, t in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, edits) in enumerate(self.items):
            cuts = [len(text) * j // (edits + 1) for j in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                found.setdefault(text[a:b], []).append((k, a))
        self.pieces = ahocorasick.Automaton()
        for piece, where in found.items():
            self.pieces.add_word(piece, (len(piece), where))
        if found:
            self.pieces.make_automaton()
        self.empty = not found

    def hits(self, text: str):
        """(item, distance, start, end) of each item that the text holds within its budget, the nearest place."""
        if self.empty:
            return
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in self.pieces.iter(text):
            for k, offset in where:
                _, item, edits = self.items[k]
                start = end + 1 - size - offset
                windows.setdefault(k, []).append((max(0, start - edits), start + len(item) + edits))
        for k in sorted(windows):
            number, item, edits = self.items[k]
            merged: list[list[int]] = []
            for a, b in sorted(windows[k]):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            best = None
            for a, b in merged:
                distance, end = myers(item, text[a:b])
                if distance <= edits and (best is None or distance < best[0]):
                    _, back = myers(item[::-1], text[a : a + end][::-1])
                    best = (distance, a + end - back, a + end)
            if best:
                yield number, *best


def item_shards(items: DataFrame, id_col: str, text_col: str) -> list[list[tuple[int, str]]]:
    """The items in lists of about SHARD_BYTES; items without an id or without words are left out."""
    usable = items.select(F.col(id_col).cast("long").alias("id"), as_bytes(text_col).alias("body")).filter("id IS NOT NULL")
    usable = publish(usable.distinct(), "items")
    total = usable.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    out = []
    for k in range(shards):
        part = usable.filter(F.pmod(F.xxhash64("id"), F.lit(shards)) == k) if shards > 1 else usable
        out.append(sorted((r["id"], t) for r in part.toLocalIterator() if (t := normal(bytes(r["body"])))))
    return out


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    chars_per_edit: int = CHARS_PER_EDIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item_id, distance, start, end): every item that a document holds with at most its budget of edits.

    Positions count characters of the text in lower case with words joined by
    one blank. Null and empty texts hold nothing; repeated rows repeat their
    hits; equal items are each reported; without items nothing is.
    """
    source = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("body"))
    schema = f"id {dict(source.dtypes)['id']}, item_id long, distance int, start long, end long"

    def finder(shard: list[tuple[int, str]]) -> Callable:
        def make():
            matcher = Matcher(shard, chars_per_edit)

            def work(rows: dict) -> dict:
                found = [(i, *hit) for i, b in zip(rows["id"], rows["body"], strict=True) for hit in matcher.hits(normal(b))]
                return {c: [f[k] for f in found] for k, c in enumerate(("id", "item_id", "distance", "start", "end"))}

            return work

        return make

    parts = [map_batches(source, schema, finder(shard)) for shard in item_shards(items, item_id_col, item_text_col)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.withColumnRenamed("id", id_col)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    chars_per_edit: int = CHARS_PER_EDIT,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` without the rows whose text holds an item within its budget; other rows stay as they are."""
    names = docs.columns
    out = docs
    for shard in item_shards(items, item_id_col, item_text_col):
        packed = out.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), as_bytes(f"`{text_col}`").alias("body"))

        def clean(batches, shard=shard):
            matcher = Matcher(shard, chars_per_edit)
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    keep = [next(matcher.hits(normal(b)), None) is None for b in part.column("body").to_pylist()]
                    yield part.select(["row"]).filter(pa.array(keep, pa.bool_()))

        out = packed.mapInArrow(clean, packed.select("row").schema).select("row.*")
    return out

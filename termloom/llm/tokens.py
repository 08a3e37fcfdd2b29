"""Edit-aware token counts.

A document keeps the lengths and token counts of its pre-tokens. Pre-tokens
stand in buckets, and a binary tree over the buckets holds the sums. An edit
finds its place by descending the tree, runs the pre-token pattern only from a
little before the edit until the old boundaries are met again, re-encodes only
those pre-tokens, and updates the sums on the paths above the buckets touched.
A pattern that looks at most ``CONTEXT`` characters past its match, and never
back, makes this exact.
"""

from __future__ import annotations

import base64
import os

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import Memo, map_batches

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters before an edit that may still change with it.
CONTEXT = 4
BUCKET = 64


class Encoder:
    """Counts of tokens by pre-token, from a public vocabulary file; made once per task."""

    def __init__(self, path: str):
        import tiktoken

        with open(os.path.realpath(path), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.count = Memo(lambda piece: len(own.encode_ordinary(piece)))
        self.pattern = regex.compile(PATTERN)


class SegmentTree:
    """Pre-token lengths and token counts in buckets under a binary tree of sums."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars = [chars[i : i + BUCKET] for i in range(0, len(chars), BUCKET)] or [[]]
        self.tokens = [tokens[i : i + BUCKET] for i in range(0, len(tokens), BUCKET)] or [[]]
        self.width = 1 << (len(self.chars) - 1).bit_length()
        self.char_sum, self.token_sum = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (c, t) in enumerate(zip(self.chars, self.tokens, strict=True)):
            self.char_sum[self.width + i], self.token_sum[self.width + i] = sum(c), sum(t)
        for node in range(self.width - 1, 0, -1):
            self.refresh(node)

    def refresh(self, node: int) -> None:
        self.char_sum[node] = self.char_sum[2 * node] + self.char_sum[2 * node + 1]
        self.token_sum[node] = self.token_sum[2 * node] + self.token_sum[2 * node + 1]

    def total(self) -> int:
        return self.token_sum[1]

    def find(self, place: int) -> tuple[int, int, int]:
        """(bucket, position in it, first character) of the pre-token that holds a character; the end if there is none."""
        node, start = 1, 0
        if place >= self.char_sum[1]:
            last = max((i for i, c in enumerate(self.chars) if c), default=0)
            return last, len(self.chars[last]), self.char_sum[1]
        while node < self.width:
            node *= 2
            if place >= start + self.char_sum[node]:
                start += self.char_sum[node]
                node += 1
        bucket = node - self.width
        for i, n in enumerate(self.chars[bucket]):
            if place < start + n:
                return bucket, i, start
            start += n
        raise AssertionError("sums and buckets disagree")

    def replace(self, first: tuple[int, int], last: tuple[int, int], chars: list[int], tokens: list[int]) -> None:
        """Put new pre-tokens in the place of those from ``first`` up to, not with, ``last`` (bucket, position)."""
        (b, i), (e, j) = first, last
        for kept, new in ((self.chars, chars), (self.tokens, tokens)):
            tail = kept[e][j:]
            if e == b:
                kept[b] = kept[b][:i] + new + tail
            else:
                kept[b] = kept[b][:i] + new
                kept[e] = tail
                for k in range(b + 1, e):
                    kept[k] = []
        nodes = set()
        for k in range(b, e + 1):
            self.char_sum[self.width + k], self.token_sum[self.width + k] = sum(self.chars[k]), sum(self.tokens[k])
            nodes.add((self.width + k) // 2)
        while nodes - {0}:
            for node in nodes:
                if node:
                    self.refresh(node)
            nodes = {n // 2 for n in nodes if n > 1}

    def leaves(self) -> tuple[list[int], list[int]]:
        return [c for bucket in self.chars for c in bucket], [t for bucket in self.tokens for t in bucket]


def edit(encoder: Encoder, text: str, tree: SegmentTree, start: int, stop: int, insert: str) -> tuple[str, int]:
    """Replace characters ``start`` to ``stop``; update the tree; return the new text and how many pre-tokens were encoded."""
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    after = text[:start] + insert + text[stop:]
    shift, settled = len(insert) - (stop - start), start + len(insert)
    bucket, at, begin = tree.find(max(0, start - CONTEXT))
    old_bucket, old_at, old = bucket, at, begin
    pieces: list[str] = []
    place = begin
    for match in encoder.pattern.finditer(after, begin):
        place = match.start()
        if place >= settled:
            while old < place - shift and old_bucket < len(tree.chars):
                if old_at < len(tree.chars[old_bucket]):
                    old += tree.chars[old_bucket][old_at]
                    old_at += 1
                else:
                    old_bucket, old_at = old_bucket + 1, 0
            if old == place - shift:
                break
        pieces.append(match.group())
    else:
        old_bucket, old_at = len(tree.chars) - 1, len(tree.chars[-1])
    if old_bucket >= len(tree.chars):
        old_bucket, old_at = len(tree.chars) - 1, len(tree.chars[-1])
    tree.replace((bucket, at), (old_bucket, old_at), [len(p) for p in pieces], [encoder.count[p] for p in pieces])
    return after, len(pieces)


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), path: str = TOKENIZER) -> DataFrame:
    """(id, text, leaf_chars, leaf_tokens, n_tokens) and the columns ``keep``: the state kept per document.

    A null text is kept as the empty text, with no pre-token.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.struct(F.lit(0).alias("_"), *keep).alias("kept"))

    def make():
        encoder = Encoder(path)

        def work(rows: dict) -> dict:
            pieces = [encoder.pattern.findall(t) for t in rows["text"]]
            tokens = [list(map(encoder.count.__getitem__, p)) for p in pieces]
            return {**rows, "leaf_chars": [list(map(len, p)) for p in pieces], "leaf_tokens": tokens, "n_tokens": [sum(t) for t in tokens]}

        return work

    kinds = source.schema
    schema = f"id {dict(source.dtypes)['id']}, text string, kept {kinds['kept'].dataType.simpleString()}, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long"
    made = map_batches(source, schema, make)
    return made.select(F.col("id").alias(id_col), "text", *[F.col(f"kept.{c}").alias(c) for c in keep], "leaf_chars", "leaf_tokens", "n_tokens")


def apply_edits(trees: DataFrame, edits_col: str = "edits", id_col: str = "doc_id", path: str = TOKENIZER) -> DataFrame:
    """Trees after their edits, done in turn: the state as ``build_trees`` would give it for the new text, and more.

    ``edits_col``: array<struct<start:long, stop:long, insert:string>> in
    characters of the text as it stands then; places outside are clipped, a null
    list or a null edit changes nothing, a null insert inserts nothing. Adds
    n_before, n_edits and n_encoded (pre-tokens encoded again).
    """
    source = trees.select(F.col(id_col).alias("id"), "text", "leaf_chars", "leaf_tokens", "n_tokens", F.col(edits_col).alias("edits"))

    def make():
        encoder = Encoder(path)

        def work(rows: dict) -> dict:
            out: dict[str, list] = {c: [] for c in ("text", "leaf_chars", "leaf_tokens", "n_tokens", "n_edits", "n_encoded")}
            for text, chars, tokens, edits in zip(rows["text"], rows["leaf_chars"], rows["leaf_tokens"], rows["edits"], strict=True):
                tree, encoded = SegmentTree(chars, tokens), 0
                todo = [e for e in edits or [] if e is not None and e["start"] is not None and e["stop"] is not None]
                for e in todo:
                    text, n = edit(encoder, text, tree, e["start"], e["stop"], e["insert"] or "")
                    encoded += n
                chars, tokens = tree.leaves()
                for c, v in zip(out, (text, chars, tokens, tree.total(), len(todo), encoded), strict=True):
                    out[c].append(v)
            return {"id": rows["id"], "n_before": rows["n_tokens"], **out}

        return work

    schema = (
        f"id {dict(source.dtypes)['id']}, text string, leaf_chars array<int>, leaf_tokens array<int>,"
        " n_before long, n_tokens long, n_edits int, n_encoded long"
    )
    return map_batches(source, schema, make).withColumnRenamed("id", id_col)

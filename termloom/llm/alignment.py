"""Alignment of two tokenizers over the same text.

Tokenizer A is a byte-level BPE of the tokenizers library, tokenizer B a
sentencepiece model. Both cut the bytes of space + text. The libraries' own
spans are the coarse cuts: character offsets for A, proto spans for B (in the
installed release ``return_type="proto"``, which took the place of the immutable
proto). A token whose span ends where the next one's begins ends there; tokens
that share one character (parts of a multibyte character in A, byte-fallback
tokens in B) are refined by the lengths of their decoded bytes.

A text is cut where a space, not the last character, follows one that is no white
space. Neither
tokenizer's tokens cross such a place if no entry of B holds a space after
another character (looked up in the model; a model with such entries gets whole
texts), so all tokens end there and the alignment of a text is the sequence of
the alignments of its stretches; common stretches are aligned once per Python worker.

Corpus-wide counts of id pairs are taken from the written links. Scoring joins
the links with the commonest pairs, a table of bounded size that is broadcast,
and the rest by a shuffle, in which no pair is frequent.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.bpe import ship_file
from termloom.llm.common import growing, map_batches
from termloom.scratch import publish

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: A link is one number: the A id times this, plus the B id.
B_IDS = 1 << 16
#: At most so many commonest pairs are broadcast.
COMMON_PAIRS = 1 << 18
#: Longer stretches are aligned anew each time; a task remembers up to twice so many shorter ones, and aligns so many new ones at once.
MEMO_CHARS = 64
MEMO_STRETCHES = 200_000
TOGETHER = 4_096

#: The space before a stretch; stretches are kept without it.
BORDER = re.compile(r"(?s) (?<=\S )(?=.)")
MARK = "▁"


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def token_ends(spans: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The byte where each token ends.

    ``spans`` are the (begin, end) of the tokens in the library's units and
    ``places`` the byte at which each unit begins. Where a token's span ends in
    no later place than the next one's begins, that is its end; between such
    coarse cuts the ends follow from the decoded sizes.
    """
    if not len(spans):
        return np.zeros(0, dtype=np.int64)
    ends = places[spans[:, 1]]
    sure = spans[:, 0] < spans[:, 1]
    sure[:-1] &= spans[:-1, 1] <= spans[1:, 0]
    total = np.cumsum(sizes)
    anchor = np.maximum.accumulate(np.where(sure, np.arange(len(spans)), -1))
    before = np.concatenate([[-1], anchor[:-1]])
    refined = total + np.where(before >= 0, ends[before] - total[before], 0)
    return np.where(sure, ends, refined)


def sizes_of(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))


class Aligner:
    """Both tokenizers in one task."""

    def __init__(self, a_json: bytes, b_model: bytes, spans: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        letters = byte_of_letter()
        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        added = {t["id"] for t in json.loads(a_json)["added_tokens"]}
        entries = {i: t.encode() if i in added else bytes(map(letters.__getitem__, t)) for t, i in self.a.get_vocab().items()}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        self.b = SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [self.b_token(p) for p in pieces]
        self.separable = not any(MARK in p.lstrip(MARK) for p in pieces)
        # Decimal ids with what follows them: within a group, at the end of a group's A part, of its B part.
        self.names = np.array([f"{i}{end}" for end in ",|;" for i in range(B_IDS)], dtype="S6")
        self.name_sizes = np.char.str_len(self.names)
        # Stretches met lately, and before: what is met again moves up, the rest is forgotten.
        self.seen: dict[str, tuple | bool] = {}
        self.older: dict[str, tuple | bool] = {}
        self.spans = spans

    def b_token(self, piece: str) -> bytes:
        """A piece's bytes: the mark is a space, <0xHH> is that byte."""
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(MARK, " ").encode()

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(A ids, A ends, B ids, B ends) of space + text; None if the bytes do not come back."""
        spaced = " " + text
        raw = spaced.encode()
        made = self.a.encode(spaced, add_special_tokens=False)
        a, offsets = made.ids, made.offsets
        parts = list(map(self.a_bytes.__getitem__, a))
        if b"".join(parts) != raw:
            return None
        starts = np.flatnonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
        spans = np.fromiter(chain.from_iterable(offsets), dtype=np.int64, count=2 * len(a)).reshape(-1, 2)
        a_ends = token_ends(spans, np.append(starts, len(raw)), sizes_of(parts))
        pieces = self.b.encode(text, return_type="proto").pieces
        b = [p.id for p in pieces]
        unknown = self.b.unk_id()
        parts = list(map(self.b_bytes.__getitem__, b))
        if unknown in b:
            parts = [self.b_token(p.piece) if p.id == unknown else part for p, part in zip(pieces, parts, strict=True)]
        if b"".join(parts) != raw:
            return None
        # Spans of B are bytes of the text without the space that B adds.
        spans = np.array([[p.begin for p in pieces], [p.end for p in pieces]], dtype=np.int64).T + 1
        b_ends = token_ends(spans, np.arange(len(raw) + 1), sizes_of(parts))
        return np.array(a, dtype=np.int64), a_ends, np.array(b, dtype=np.int64), b_ends

    def align(self, stretches: list[str]) -> list[tuple | bool]:
        """Per stretch (A tokens, B tokens, groups, links, groups as text, links; with spans A ends and B ends), False if the bytes do not come back; lists are int32 bytes.

        Stretches that may stand one after the other, a space before each, are
        aligned as one text and taken apart at their borders.
        """
        made = self.tokens(" ".join(stretches))
        if made is None:
            return [False] if len(stretches) == 1 else [x for s in stretches for x in self.align([s])]
        a, a_ends, b, b_ends = made
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        first = np.searchsorted(b_ends, np.concatenate([[0], a_ends[:-1]]), side="right")
        n = np.searchsorted(b_ends, a_ends) + 1 - first
        upto = np.cumsum(n)
        which = np.arange(upto[-1]) - np.repeat(upto - n - first, n)
        links = (np.repeat(a, n) * B_IDS + b[which]).astype("<u4").tobytes()
        # Ids as text, the A part of a group before its B part.
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_last, b_last = cuts[a_group] == a_ends, cuts[b_group] == b_ends
        a_upto, b_upto = np.cumsum(np.bincount(a_group)), np.cumsum(np.bincount(b_group))
        named = np.empty(len(a) + len(b), dtype=np.int64)
        named[np.arange(len(a)) + np.concatenate([[0], b_upto])[a_group]] = a + B_IDS * a_last
        named[np.arange(len(b)) + a_upto[b_group]] = b + 2 * B_IDS * b_last
        text = self.names[named].tobytes().replace(b"\0", b"")
        text_upto = np.concatenate([[0], np.cumsum(self.name_sizes[named])])
        borders = np.cumsum([len(s.encode()) + 1 for s in stretches])
        a_at, b_at, g_at = (np.concatenate([[0], np.searchsorted(e, borders) + 1]) for e in (a_ends, b_ends, cuts))
        edges = np.stack([a_at, b_at, g_at, np.concatenate([[0], upto])[a_at], text_upto[a_at + b_at]], axis=1).tolist()
        made = [
            (a1 - a0, b1 - b0, g1 - g0, l1 - l0, text[t0 : t1 - 1], links[4 * l0 : 4 * l1])
            for (a0, b0, g0, l0, t0), (a1, b1, g1, l1, t1) in pairwise(edges)
        ]
        if not self.spans:
            return made
        starts = np.concatenate([[0], borders[:-1]])
        ends = [(e - np.repeat(starts, np.diff(at))).astype("<i4").tobytes() for e, at in ((a_ends, a_at), (b_ends, b_at))]
        cut = zip(pairwise((4 * a_at).tolist()), pairwise((4 * b_at).tolist()), strict=True)
        return [(*m, ends[0][p:q], ends[1][u:v]) for m, ((p, q), (u, v)) in zip(made, cut, strict=True)]

    def learn(self, texts: list[list[str]]) -> None:
        """Align the stretches of these texts that are short and new, many at once."""
        wanted = {s for s in set().union(*texts) if len(s) <= MEMO_CHARS and not s[-1:].isspace()}
        if len(self.seen) > MEMO_STRETCHES:
            self.seen, self.older = {}, self.seen
        new = wanted - self.seen.keys()
        again = new & self.older.keys()
        self.seen.update((s, self.older[s]) for s in again)
        new = list(new - again)
        for i in range(0, len(new), TOGETHER):
            self.seen.update(zip(new[i : i + TOGETHER], self.align(new[i : i + TOGETHER]), strict=True))

    def texts(self, texts: list[str]) -> list[tuple]:
        """The alignments of whole texts; zeros and empty lists if some bytes do not come back."""
        cut = [[] if not t else BORDER.split(t) if self.separable else [t] for t in texts]
        self.learn(cut)
        return list(map(self.joined, cut))

    def joined(self, stretches: list[str]) -> tuple:
        made = list(map(self.seen.get, stretches))
        if None in made:
            made = [m if m is not None else self.align([s])[0] for s, m in zip(stretches, made, strict=True)]
        if not made or False in made:
            return (0, 0, 0, 0, b"", b"", *([b"", b""] if self.spans else []))
        a, b, groups, links, names, codes, *ends = zip(*made, strict=True)
        if self.spans:
            starts = np.cumsum([0, *(len(s.encode()) + 1 for s in stretches[:-1])])
            ends = [
                (np.frombuffer(b"".join(part), dtype="<i4") + np.repeat(starts, counts)).astype("<i4").tobytes()
                for part, counts in zip(ends, (a, b), strict=True)
            ]
        return sum(a), sum(b), sum(groups), sum(links), b";".join(names), b"".join(codes), *ends


@lru_cache(maxsize=1)
def worker_aligner(a_json: bytes, b_model: bytes, spans: bool) -> Aligner:
    """The tokenizers of a Python worker with the stretches it remembers; its next task finds both ready."""
    return Aligner(a_json, b_model, spans)


def align_tokenizers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, spans: bool = False
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, links) of every text, with ``spans`` also a_ends and b_ends.

    ``groups`` names the ids of each group, ``a1,a2|b1;a3|b2,b3``; ``links`` holds
    A id * 65536 + B id, unsigned in 32 bits, of every overlapping pair of tokens
    in the order of A; the ends are bytes of space + text. A null or empty text,
    and one that the tokens do not give back byte by byte, has zeros and empty
    lists. Every row keeps its place, also repeated rows and null ids; other
    columns, whatever their names, are not read. Texts of any length are taken
    whole.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    a_json, b_model = ship_file(docs.sparkSession, a_path), ship_file(docs.sparkSession, b_path)
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "links", *(["a_ends", "b_ends"] if spans else [])]

    def make():
        aligner = worker_aligner(a_json.value, b_model.value, spans)

        def work(rows: dict) -> dict:
            with growing():
                made = aligner.texts(rows["text"])
            columns = dict(zip(names, map(list, zip(*made, strict=True)), strict=False))
            lists = {c: [np.frombuffer(v, dtype="<i4") for v in columns[c]] for c in names[5:]}
            return {"id": rows["id"], **columns, **lists}

        return work

    kinds = ["long", "long", "long", "long", "string", *["array<int>"] * (len(names) - 5)]
    schema = ", ".join([f"id {dict(source.dtypes)['id']}", *(f"{c} {k}" for c, k in zip(names, kinds, strict=True))])
    return map_batches(source, schema, make).withColumnRenamed("id", id_col)


def b_id(link: Column) -> Column:
    return link.bitwiseAND(F.lit(B_IDS - 1))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(link, n, best) of every distinct id pair: how many links hold it, and whether no pair of its B id has more.

    B ids are less than 65 536, so the table of the best counts is bounded.
    """
    counts = publish(aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n")), "pairs")
    best = counts.groupBy(b_id(F.col("link")).alias("b")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(best), b_id(F.col("link")) == F.col("b")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def common_floor(counts: DataFrame, common: int) -> int:
    """The least count such that at most ``common`` pairs have it or more."""
    floor, kept = 2**62, 0
    for step in counts.groupBy("n").agg(F.count("*").alias("pairs")).orderBy(F.desc("n")).limit(common).collect():
        kept += step["pairs"]
        if kept > common:
            break
        floor = step["n"]
    return floor


def score_links(aligned: DataFrame, row_col: str, counts: DataFrame, common: int = COMMON_PAIRS) -> DataFrame:
    """(row, n_best, count_sum): sums of the counts over the links of each row that has any."""
    floor = common_floor(counts, common)
    head, tail = counts.filter(F.col("n") >= floor), counts.filter(F.col("n") < floor)
    links = aligned.select(F.col(row_col).alias("row"), F.explode("links").alias("link"))
    sums = (F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("n").alias("count_sum"))
    scored = links.join(F.broadcast(head), "link").groupBy("row").agg(*sums)
    rare = links.join(F.broadcast(head.select("link")), "link", "left_anti").join(tail, "link").groupBy("row").agg(*sums)
    return scored.unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text.

    ``count_sum`` adds, over the links of a text, how many links of all texts
    hold the same pair of ids; ``n_best`` counts its links whose pair is the most
    frequent one of its B id, ties included. Rows are handled as in
    ``align_tokenizers``; an empty table gives an empty result.
    """
    aligned = align_tokenizers(docs, id_col, text_col, a_path, b_path)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    kept = aligned.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links"
    )
    written = publish(kept, "alignments")
    counts = publish(pair_counts(written), "pair_counts")
    scored = written.drop("links").join(score_links(written, "row", counts), "row", "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return scored.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256")

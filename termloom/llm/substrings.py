"""Removal of word windows that an earlier document already has.

0. Exact copies of an earlier text lose all their windows; they are found by the
   md5 of the text and take no further part.
1. Every window is known by its anchor, the smallest hash among its inner
   phrases; equal windows have equal anchors. Anchors met at least twice are
   counted and marked in a bitmap of fixed size, a filter only: with more input
   it lets more windows through, never fewer.
2. Windows with a marked anchor are confirmed exactly: those of which the first
   document comes before another one are the repeated passages.
3. Documents are dealt to small blocks. Each block gets the repeated windows
   that occur in it, once each, compiles them (in shards of bounded size) into
   Aho-Corasick automata over words, and streams its documents through them, to
   locate every occurrence. So each document meets only the passages of its own
   block, and the work grows with the input.

Words reach the automata as single characters: a shard numbers its words.
"""

from __future__ import annotations

import hashlib
from itertools import chain, compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termloom.llm.common import SLICE_ROWS, as_bytes, map_batches
from termloom.scratch import publish

#: Bits of the marks of repeated anchors, and of documents that hold repeated windows.
MARK_BITS = 26
#: Bytes of text in a block of documents, about.
BLOCK_BYTES = 1_000_000
#: Windows in an automaton, at most; their words fit the characters that Python has.
SHARD = 40_000
#: Characters that can stand for words.
LETTERS = 1_100_000
#: Bytes of texts that are hashed at once, about.
PART_BYTES = 1 << 20
LAST_ID = 2**63 - 1
FIRST_BASE, SECOND_BASE, ANCHOR_BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def rolled(codes: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """A hash of every run of ``size`` codes."""
    n = len(codes) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(size):
        out = out * base + codes[j : j + n] if n > 0 else out
    return (out ^ (out >> np.uint64(31))) * base


class Words:
    """Hashes of the words of texts, from the bytes of many texts at once."""

    def __init__(self):
        rng = np.random.default_rng(2024)
        self.letter = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> np.ndarray:
        while len(self.power) < n:
            onward = self.power[-1:] * FIRST_BASE
            self.power = np.concatenate([self.power, self.power * onward])
        return self.power

    def part(self, text: np.ndarray) -> np.ndarray:
        """A hash of every word of a text that ends with a blank."""
        blank = BLANK[text]
        before = np.concatenate([[True], blank[:-1]])
        starts = np.flatnonzero(~blank & before)
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = np.flatnonzero(blank & ~before) - starts
        letters = self.letter[text[~blank]]
        firsts = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(firsts, lengths)
        code = np.add.reduceat(letters * self.powers(int(lengths.max()))[place], firsts)
        code ^= code >> np.uint64(32)
        return code * SECOND_BASE

    def of(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words, and how many words each text has."""
        hashes, counts, part, size = [], [], [], 0
        for i, body in enumerate(bodies):
            part.append(body)
            size += len(body)
            if size >= PART_BYTES or i == len(bodies) - 1:
                text = np.frombuffer(b" ".join(part) + b" ", dtype=np.uint8)
                code = self.part(text)
                ends = np.cumsum([len(b) + 1 for b in part])
                blank = BLANK[text]
                first = ~blank & np.concatenate([[True], blank[:-1]])
                seen = np.concatenate([[0], np.cumsum(first)])[np.concatenate([[0], ends])]
                hashes.append(code)
                counts.append(np.diff(seen))
                part, size = [], 0
        if not hashes:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        return np.concatenate(hashes), np.concatenate(counts).astype(np.int64)


class Windows:
    """Hashes of the windows of some texts; made once per task."""

    def __init__(self, size: int):
        self.size = size
        self.phrase = (size + 1) // 2  # words of an inner phrase
        self.words = Words()

    def starts(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, first word counted over all documents) of every window."""
        rooms = np.maximum(lengths - self.size + 1, 0)
        doc = np.repeat(np.arange(len(lengths)), rooms)
        within = np.arange(rooms.sum()) - np.repeat(np.cumsum(rooms) - rooms, rooms)
        return doc, (np.cumsum(lengths) - lengths)[doc] + within

    def anchors(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The anchor of each window."""
        inner = rolled(codes, self.phrase, ANCHOR_BASE)
        n = len(codes) - self.size + 1
        anchor = inner[:n].copy()
        for j in range(1, self.size - self.phrase + 1):
            np.minimum(anchor, inner[j : j + n], out=anchor)
        return anchor[at]

    def anchors_of(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """document and anchor of every window."""
        codes, lengths = self.words.of(bodies)
        doc, at = self.starts(lengths)
        return doc, self.anchors(codes, at) if len(doc) else np.zeros(0, dtype=np.uint64)

    def of(self, bodies: list[bytes], with_anchor: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """document, anchor (if asked for), first and second hash of every window."""
        codes, lengths = self.words.of(bodies)
        doc, at = self.starts(lengths)
        if not len(doc):
            none = np.zeros(0, dtype=np.uint64)
            return doc, none, none, none
        first, second = rolled(codes, self.size, FIRST_BASE)[at], rolled(codes, self.size, SECOND_BASE)[at]
        return doc, self.anchors(codes, at) if with_anchor else first, first, second >> np.uint64(33)

    def first_hashes(self, body: bytes) -> np.ndarray:
        codes, _ = self.words.of([body])
        return rolled(codes, self.size, FIRST_BASE)


def marks_of(table: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size in which two bits are set for each value of a column of hashes.

    It only ever lets too much through: what it lets through is checked exactly.
    """
    places = F.array(
        F.shiftrightunsigned(column, 64 - MARK_BITS), F.shiftrightunsigned(column, 64 - 2 * MARK_BITS).bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    )
    slots = table.select(F.explode(places).alias("p"))
    words = slots.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    out = np.zeros(1 << (MARK_BITS - 6), dtype=np.uint64)
    found = words.toArrow()  # at most 2**(MARK_BITS - 6) rows
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return out


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of each uint64 hash are set."""
    out = np.ones(len(hashes), dtype=bool)
    for shift in (64 - MARK_BITS, 64 - 2 * MARK_BITS):
        place = (hashes >> np.uint64(shift)).astype(np.int64) & ((1 << MARK_BITS) - 1)
        out &= (bitmap[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def cut_words(body: bytes, gone: np.ndarray) -> bytes:
    """The text without the words marked ``gone``, each with the blanks after it."""
    text = np.frombuffer(body, dtype=np.uint8)
    blank = BLANK[text]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    stays = np.repeat(np.concatenate([[True], ~gone]), np.diff(np.concatenate([[0], starts, [len(body)]])))
    return text[stays].tobytes()


def as_letters(words: list[list[bytes]], wanted: set[bytes] | None = None) -> list[str]:
    """Each text as one character per word; words that are not wanted share a character."""
    letters: dict[bytes, str] = {}
    for w in chain.from_iterable(words):
        if w not in letters and (wanted is None or w in wanted):
            code = len(letters) + 2
            letters[w] = chr(code if code < 0xD800 else code + 0x800)
    if wanted is None:
        return ["".join(map(letters.__getitem__, own)) for own in words]
    other = chr(1)
    return ["".join([letters.get(w, other) for w in own]) for own in words]


def locate(words: list[list[bytes]], order: list[int], passages: list[tuple[int, int, int]], size: int) -> list[np.ndarray]:
    """For each document, which words are covered by a passage whose first document comes earlier.

    passages: (document, first word, first document's id) of one occurrence each.
    """
    covered = [np.zeros(len(w) + 1, dtype=np.int64) for w in words]
    distinct = len(set(chain.from_iterable(words)))
    lines = as_letters(words) if distinct <= LETTERS else None
    for at in range(0, len(passages), SHARD):
        shard = passages[at : at + SHARD]
        own_lines = lines or as_letters(words, {w for i, start, _ in shard for w in words[i][start : start + size]})
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, (i, start, _) in enumerate(shard):
            automaton.add_word(own_lines[i][start : start + size], k)
        automaton.make_automaton()
        firsts = [first for _, _, first in shard]
        for i, line in enumerate(own_lines):
            if len(line) >= size:
                ends = [end for end, k in automaton.iter(line) if firsts[k] < order[i]]
                if ends:
                    np.add.at(covered[i], np.array(ends) - size + 1, 1)
                    np.add.at(covered[i], np.array(ends) + 1, -1)
    return [np.cumsum(c[:-1]) > 0 for c in covered]


def copy_mark() -> Column:
    return F.xxhash64("ord", F.md5("body"))


def split_copies(base: DataFrame) -> tuple[DataFrame, DataFrame, object]:
    """Copies of a text with a smaller ``ord``; rows that share a copy's mark but are none; the marks.

    The marks are a bitmap of fixed size, so most rows are told apart without a
    shuffle of texts; only the marked rows are joined with the exact list.
    """
    spark = base.sparkSession
    thin = publish(base.select("ord", F.md5("body").alias("md5"), copy_mark().alias("mark")), "texts")
    first = thin.groupBy("md5").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).filter("first < last")
    later = publish(thin.distinct().join(first, "md5").filter("ord > first").select("md5", "ord", "mark"), "copies")
    copy_marks = spark.sparkContext.broadcast(marks_of(later, "mark"))

    def marked_rows(batches):
        for batch in batches:
            yield batch.filter(pa.array(marked(copy_marks.value, batch.column("mark").to_numpy().view(np.uint64))))

    sided = base.withColumn("mark", copy_mark())
    suspects = publish(sided.mapInArrow(marked_rows, sided.schema).drop("mark").withColumn("md5", F.md5("body")), "suspects")
    keys = later.select("md5", "ord")
    copies = suspects.join(keys, ["md5", "ord"], "left_semi").drop("md5")
    others = suspects.join(keys, ["md5", "ord"], "left_anti").drop("md5")
    return copies.select(base.columns), publish(others.select(base.columns), "suspects"), copy_marks


def remove_repeats(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed and kept_sha256; the text loses the removed words.

    A word goes if a window of ``size`` words around it also starts in a
    document with a smaller id, judged on the input. kept_sha256 is over the
    kept words joined by one blank. A null text is empty and stays null; texts
    under ``size`` words lose nothing; a null id comes after all ids, and rows
    with the same id (or none) never remove from each other. Columns named like
    the new ones are replaced; an empty table gives an empty result.
    """
    made = ["n_words", "n_removed", "kept_sha256"]
    names = [c for c in docs.columns if c not in made]
    rest = [c for c in names if c != text_col]
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    blocks = max(16, -(-total // BLOCK_BYTES))
    body = as_bytes(f"`{text_col}`")
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID))
    row = F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(True).alias("_")).alias("row")
    no_text = F.col(f"`{text_col}`").isNull().alias("no_text")
    base = docs.select(
        F.pmod(F.xxhash64(order, body), F.lit(blocks)).cast("int").alias("block"), order.alias("ord"), body.alias("body"), no_text, row
    )
    spark = docs.sparkSession
    copies, others, copy_marks = split_copies(base)
    # a marked row is a copy or stands again, without a mark, among the others
    base = base.withColumn("mark", copy_mark()).unionByName(others.withColumn("mark", F.lit(None).cast("long")))
    thin = base.select("block", "ord", "body", "mark")

    def kept_rows(rows: dict) -> dict:
        """The rows of a slice without those marked as copies."""
        mark = np.array([0 if m is None else m for m in rows["mark"]], dtype=np.int64).view(np.uint64)
        keep = ~marked(copy_marks.value, mark) | np.array([m is None for m in rows["mark"]])
        at = np.flatnonzero(keep).tolist()
        return {c: [rows[c][i] for i in at] for c in rows}

    def anchors():
        windows = Windows(size)

        def work(rows: dict) -> dict:
            doc, anchor = windows.anchors_of(kept_rows(rows)["body"])
            fresh = np.ones(len(doc), dtype=bool)
            fresh[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
            return {"anchor": anchor[fresh].view(np.int64)}

        return work

    repeated = map_batches(thin.select("body", "mark"), "anchor long", anchors).groupBy("anchor").count().filter("count > 1")
    anchor_marks = spark.sparkContext.broadcast(marks_of(repeated, "anchor"))

    def candidates(marks, by_anchor: bool):
        """Hashes, id and block of the windows that the marks let through, by their anchor or their own hash."""

        def make():
            windows = Windows(size)

            def work(rows: dict) -> dict:
                rows = kept_rows(rows)
                doc, anchor, first, second = windows.of(rows["body"], by_anchor)
                hit = np.flatnonzero(marked(marks.value, anchor if by_anchor else first))
                doc, first, second = doc[hit], first[hit], second[hit]
                fresh = np.ones(len(doc), dtype=bool)
                fresh[1:] = (doc[1:] != doc[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
                doc = doc[fresh]
                return {
                    "h1": first[fresh].view(np.int64), "h2": second[fresh].astype(np.int32),
                    "ord": np.array(rows["ord"], dtype=np.int64)[doc], "block": np.array(rows["block"], dtype=np.int32)[doc],
                }

            return work

        return map_batches(thin, "h1 long, h2 int, ord long, block int", make)

    met = candidates(anchor_marks, True).drop("block")
    confirmed = met.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).filter("first < last")
    confirmed = publish(confirmed.drop("last"), "confirmed")
    window_marks = spark.sparkContext.broadcast(marks_of(confirmed, "h1"))
    found = candidates(window_marks, False).join(confirmed, ["h1", "h2"]).filter("ord > first")
    found = publish(found.select("block", "h1", "h2", "ord", "first"), "passages")
    passages = found.groupBy("block", "h1", "h2").agg(F.min("ord").alias("ord"), F.min("first").alias("first")).drop("h2")
    touched = spark.sparkContext.broadcast(marks_of(found.select(F.xxhash64("ord").alias("o")).distinct(), "o"))

    out_row = T.StructType([*base.schema["row"].dataType.fields])
    result = T.StructType([
        T.StructField("row", out_row), T.StructField("body", T.BinaryType()), T.StructField("no_text", T.BooleanType()),
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    ])
    arrow = to_arrow_schema(result)

    def chosen(batch: pa.RecordBatch, want: bool) -> pa.RecordBatch:
        """The rows that are no copies and whose id is marked as holding passages, or is not."""
        mark = batch.column("mark")
        copied = marked(copy_marks.value, mark.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
        copied &= mark.is_valid().to_numpy(zero_copy_only=False)
        holds = marked(touched.value, batch.column("o").to_numpy().view(np.uint64))
        return batch.filter(pa.array(~copied & (holds == want)))

    def plain(batches):
        """The rows without passages, chosen and finished by one worker."""
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = chosen(batch.slice(start, SLICE_ROWS), False)
                if not part.num_rows:
                    continue
                words = [b.split() for b in part.column("body").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("row").cast(arrow.field("row").type), part.column("body").cast(pa.binary()), part.column("no_text"),
                    pa.array([len(w) for w in words], pa.int64()), pa.array([0] * len(words), pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words]),
                ], schema=arrow)

    def holding(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield chosen(batch.slice(start, SLICE_ROWS), True)

    def through(left: pa.Table, right: pa.Table) -> pa.Table:
        bodies, order = left.column("body").to_pylist(), left.column("ord").to_pylist()
        words = [b.split() for b in bodies]
        windows, by_id = Windows(size), {}
        for i, o in enumerate(order):
            by_id.setdefault(o, []).append(i)
        # a passage is known by its hash in one of the block's documents: find its words there
        wanted, owner, firsts = (right.column(c).to_numpy() for c in ("h1", "ord", "first"))
        turn = np.argsort(owner, kind="stable")
        found_at: list[tuple[int, int, int]] = []
        for rows in np.split(turn, np.flatnonzero(np.diff(owner[turn])) + 1) if len(turn) else []:
            for i in by_id.get(int(owner[rows[0]]), ()):
                hashes = windows.first_hashes(bodies[i]).view(np.int64)
                if len(hashes) and len(rows):
                    by_hash = np.argsort(hashes)
                    place = by_hash[np.minimum(np.searchsorted(hashes, wanted[rows], sorter=by_hash), len(hashes) - 1)]
                    here = hashes[place] == wanted[rows]
                    found_at += zip([i] * int(here.sum()), place[here].tolist(), firsts[rows[here]].tolist(), strict=True)
                    rows = rows[~here]
        gone = locate(words, order, found_at, size)
        kept = [compress(own, (~lost).tolist()) for own, lost in zip(words, gone, strict=True)]
        texts = [cut_words(b, lost) if lost.any() else b for b, lost in zip(bodies, gone, strict=True)]
        return pa.Table.from_arrays([
            left.column("row").cast(arrow.field("row").type), pa.array(texts, pa.binary()), left.column("no_text"),
            pa.array([len(w) for w in words], pa.int64()), pa.array([int(x.sum()) for x in gone], pa.int64()),
            pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for k in kept]),
        ], schema=arrow)

    sided = base.withColumn("o", F.xxhash64("ord"))

    untouched = sided.mapInArrow(plain, result)
    dealt = sided.mapInArrow(holding, sided.schema).select("block", "ord", "body", "no_text", "row")
    located = dealt.groupBy("block").cogroup(passages.groupBy("block")).applyInArrow(through, result)

    def emptied(batches):
        """A copy of an earlier text: all its windows start there."""
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                bodies = part.column("body").to_pylist()
                words = [b.split() for b in bodies]
                gone = [len(w) if len(w) >= size else 0 for w in words]
                yield pa.RecordBatch.from_arrays([
                    part.column("row").cast(arrow.field("row").type),
                    pa.array([b"" if g else b for b, g in zip(bodies, gone, strict=True)], pa.binary()), part.column("no_text"),
                    pa.array([len(w) for w in words], pa.int64()), pa.array(gone, pa.int64()),
                    pa.array([hashlib.sha256(b"" if g else b" ".join(w)).hexdigest() for w, g in zip(words, gone, strict=True)]),
                ], schema=arrow)

    copied = copies.select("row", "body", "no_text").mapInArrow(emptied, result)
    text = F.when(~F.col("no_text"), F.col("body").cast("string"))
    columns = [text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in names]
    return untouched.unionAll(located).unionAll(copied).select(*columns, *made)

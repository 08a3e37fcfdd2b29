"""Byte-level BPE by prefix dynamic programming.

Every prefix of a pre-token has exactly one valid last token: the token that
plain merging of that prefix would end with. It is found from shorter prefixes:
among the tokens that end at a byte (met by an automaton over the vocabulary)
it is the one that may follow the last token of the prefix before it. Two tokens
may stand side by side if, while both are built up merge by merge, no merge
across their border would come first. The table of last tokens is the state: a
longer text only adds entries, and an edit recomputes entries until they agree
with the old ones for as many bytes as the longest token has.

Rank files hold ``base64(token) rank`` lines. The driver reads the file and
ships its bytes (about a megabyte), so executors need no copy of it.
"""

from __future__ import annotations

import base64
import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termloom.llm.common import SLICE_ROWS, Memo, growing, map_batches

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters before an edit whose pre-tokens may still change with it.
LOOK_BACK = 4
#: A task remembers so many pre-tokens; longer ones are encoded anew each time.
MEMO_PIECES = 600_000
MEMO_CHARS = 64
MEMO_PAIRS = 2_000_000


def ship_file(spark: SparkSession, path: str):
    """A small driver-side file as a broadcast of its bytes."""
    with open(path, "rb") as lines:
        return spark.sparkContext.broadcast(lines.read())


class PrefixCoder:
    """Last tokens of prefixes, for one vocabulary; made once per task."""

    def __init__(self, rank_lines: bytes):
        import ahocorasick

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_lines.splitlines())}
        self.tokens = dict(zip(self.ranks.values(), self.ranks, strict=True))
        self.longest = max(map(len, self.ranks))
        self.ends = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ends.make_automaton()
        self.split = Memo(self._split)
        self.spines = Memo(self._spines)
        # For a token, which tokens may follow it, as far as asked.
        self.after: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self.pairs = 0

    def _split(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte, ``()`` where merging never makes it."""
        parts = [bytes([b]) for b in self.tokens[rank]]
        if len(parts) == 1:
            return None
        while len(parts) > 2:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], math.inf), i) for i in range(len(parts) - 1))
            if best == math.inf:
                return ()
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _spines(self, rank: int) -> tuple[list, list]:
        """What stands at the left and at the right border while the token is built: (bytes, rank of the merge that ends it)."""
        spines = []
        for side in (0, 1):
            spine, now, until = [], rank, math.inf
            while True:
                spine.append((self.tokens[now], until))
                parts = self.split[now]
                if not parts:
                    break
                now, until = parts[side], now
            spines.append(spine)
        return tuple(spines)

    def fits(self, left: int, right: int) -> bool:
        """Do these two tokens stay apart?"""
        known = self.after[left].get(right)
        if known is None:
            self.pairs += 1
            if self.pairs > MEMO_PAIRS:
                self.after.clear()
                self.pairs = 1
            known = self.after[left][right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Of equal merges the leftmost comes first."""
        for x, until_x in self.spines[left][1]:
            for y, until_y in self.spines[right][0]:
                merge = self.ranks.get(x + y)
                if merge is not None and merge < until_x and merge <= until_y:
                    return False
        return True

    def extend(self, piece: bytes, last: list[int], old: list[int] | None = None, shift: int = 0) -> int:
        """Fill ``last`` up to the end of ``piece``; return the number of entries computed.

        With ``old``, the table of a text that agrees with this one from here on
        (there ``shift`` bytes earlier), the rest is copied once as many entries
        agree as the longest token has bytes.
        """
        begin, agreed = len(last), 0
        start = max(0, begin - self.longest + 1)
        for end, (rank, n) in self.ends.iter(piece.decode("latin-1"), start):
            if end < len(last):
                continue
            if self.split[rank] != () if n == end + 1 else self.fits(last[end - n], rank):
                last.append(rank)
                if old is not None:
                    at = end - shift
                    agreed = agreed + 1 if 0 <= at < len(old) and old[at] == rank else 0
                    if agreed >= self.longest:
                        last += old[at + 1 :]
                        return end + 1 - begin
        return len(last) - begin

    def walk(self, last: list[int]) -> list[int]:
        """The tokens of a whole pre-token, from its table."""
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.tokens[ids[-1]])
        return ids[::-1]

    def table(self, piece: bytes) -> list[int]:
        """The last token of every prefix."""
        split, after, last, done = self.split, self.after, [], 0
        for end, (rank, n) in self.ends.iter(piece.decode("latin-1")):
            if end == done:
                if n <= end:
                    known = after[last[end - n]].get(rank)
                    if not (self.fits(last[end - n], rank) if known is None else known):
                        continue
                elif split[rank] == ():
                    continue
                last.append(rank)
                done += 1
        return last

    def encode(self, piece: bytes) -> list[int]:
        """A pre-token that is itself an entry is that entry, also where merging never makes it."""
        own = self.ranks.get(piece)
        return [own] if own is not None and self.split[own] == () else self.walk(self.table(piece))


class TextCoder:
    """Encodes whole texts, pre-token by pre-token; common pre-tokens are encoded once per task."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.coder = PrefixCoder(rank_lines)
        self.pattern = regex.compile(pattern)
        self.seen: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pattern.findall(text):
            known = self.seen.get(piece)
            if known is None:
                known = tuple(self.coder.encode(piece.encode()))
                if len(piece) <= MEMO_CHARS:
                    if len(self.seen) >= MEMO_PIECES:
                        self.seen.clear()
                    self.seen[piece] = known
            ids += known
        return ids


class EditedText:
    """A text with its pre-token lengths (in characters) and its table of last tokens (one per byte)."""

    def __init__(self, own: TextCoder, text: str, chars: list[int], last: list[int]):
        self.own, self.text, self.chars, self.last = own, text, chars, last
        self.computed = 0

    @classmethod
    def fresh(cls, own: TextCoder, text: str) -> EditedText:
        pieces = own.pattern.findall(text)
        last = [rank for p in pieces for rank in own.coder.table(p.encode())]
        return cls(own, text, list(map(len, pieces)), last)

    def ids(self) -> list[int]:
        out, char, byte = [], 0, 0
        for n in self.chars:
            size = len(self.text[char : char + n].encode())
            out += self.own.coder.walk(self.last[byte : byte + size])
            char, byte = char + n, byte + size
        return out

    def edit(self, start: int, stop: int, insert: str) -> None:
        """Replace characters ``start`` to ``stop`` (clipped to the text); recompute only what changes."""
        start = min(max(start, 0), len(self.text))
        stop = min(max(stop, start), len(self.text))
        after = self.text[:start] + insert + self.text[stop:]
        moved = len(insert) - (stop - start)
        first, char = 0, 0
        while first < len(self.chars) and char + self.chars[first] <= start - LOOK_BACK:
            char += self.chars[first]
            first += 1
        head_bytes = len(self.text[:char].encode())
        until, old_char = first, char
        pieces: list[str] = []
        for match in self.own.pattern.finditer(after, char):
            if match.start() >= start + len(insert):
                while until < len(self.chars) and old_char < match.start() - moved:
                    old_char += self.chars[until]
                    until += 1
                if old_char == match.start() - moved:
                    break
            pieces.append(match.group())
        else:
            until, old_char = len(self.chars), len(self.text)
        stop_bytes = head_bytes + len(self.text[char:old_char].encode())
        old_from = len(self.text[:stop].encode())
        made, place = [], head_bytes
        moved_bytes = len(insert.encode()) - len(self.text[start:stop].encode())
        tables = self._old_tables(first, until, char, head_bytes)
        for piece in pieces:
            raw = piece.encode()
            known = tables.get(place) if place < head_bytes + len(self.text[char:start].encode()) else None
            same = self._common(raw, known)
            last = known[1][:same] if known else []
            # The old pre-token that held this one's last byte, if the two end alike.
            tail = next((t for at, t in tables.items() if at + len(t[0]) == place + len(raw) - moved_bytes and at + len(t[0]) > old_from), None)
            if tail and same < len(raw):
                old_at = place + len(raw) - moved_bytes - len(tail[0])
                untouched = max(place, old_from + moved_bytes) - place
                if untouched > same:
                    self.computed += self.own.coder.extend(raw[:untouched], last)
                if len(last) >= untouched:
                    self.computed += self.own.coder.extend(raw, last, tail[1], old_at + moved_bytes - place)
            else:
                self.computed += self.own.coder.extend(raw, last)
            made += last
            place += len(raw)
        self.last = self.last[:head_bytes] + made + self.last[stop_bytes:]
        self.chars = self.chars[:first] + list(map(len, pieces)) + self.chars[until:]
        self.text = after

    def _old_tables(self, first: int, until: int, char: int, byte: int) -> dict[int, tuple[bytes, list[int]]]:
        """{first byte: (bytes, last tokens)} of the old pre-tokens that an edit may touch."""
        tables = {}
        for n in self.chars[first:until]:
            raw = self.text[char : char + n].encode()
            tables[byte] = raw, self.last[byte : byte + len(raw)]
            char, byte = char + n, byte + len(raw)
        return tables

    @staticmethod
    def _common(raw: bytes, known: tuple[bytes, list[int]] | None) -> int:
        if known is None:
            return 0
        n = min(len(raw), len(known[0]))
        if raw[:n] == known[0][:n]:
            return n
        low, high = 0, n
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if raw[:middle] == known[0][:middle] else (low, middle - 1)
        return low


def _texts(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), *more)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, ids array<int>) of every text.

    A null or empty text has no tokens. Every row keeps its place, also repeated
    rows and null ids; other columns, whatever their names, are not read. Texts
    of any length are encoded whole, in time in proportion to their length.
    """
    source = _texts(docs, id_col, text_col)
    ranks = ship_file(docs.sparkSession, path)

    def make():
        own = TextCoder(ranks.value, pattern)

        def work(rows: dict) -> dict:
            with growing():
                return {"id": rows["id"], "ids": list(map(own.encode, rows["text"]))}

        return work

    made = map_batches(source, f"id {dict(source.dtypes)['id']}, ids array<int>", make)
    return made.withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, id_col: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """(id, ids, decoded binary) of id lists; a null list has no bytes, an id outside the vocabulary is an error."""
    source = encoded.select(F.col(id_col).alias("id"), "ids")
    ranks = ship_file(encoded.sparkSession, path)

    arrow = to_arrow_schema(T._parse_datatype_string(schema := f"id {dict(source.dtypes)['id']}, ids array<int>, decoded binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = {int(b): base64.b64decode(a) for a, b in map(bytes.split, ranks.value.splitlines())}
        tokens = [entries.get(i) for i in range(max(entries) + 1)]
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                ids, lists = (batch.column(c).slice(start, SLICE_ROWS) for c in ("id", "ids"))
                sizes = lists.value_lengths().fill_null(0).to_numpy()
                flat = lists.flatten().to_numpy().tolist()
                upto = [0, *np.cumsum(sizes).tolist()]
                decoded = pa.array([b"".join(map(tokens.__getitem__, flat[a:b])) for a, b in pairwise(upto)], type=pa.binary())
                yield pa.RecordBatch.from_arrays([ids, lists.cast(arrow.field("ids").type), decoded], schema=arrow)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


STATE = "text string, piece_chars array<int>, last_tokens array<int>"


def build_prefix_tables(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, text, piece_chars, last_tokens): the state from which appends and edits go on. Rows as in ``encode_texts``."""
    source = _texts(docs, id_col, text_col)
    ranks = ship_file(docs.sparkSession, path)

    def make():
        own = TextCoder(ranks.value, pattern)

        def work(rows: dict) -> dict:
            made = [EditedText.fresh(own, t) for t in rows["text"]]
            return {**rows, "piece_chars": [m.chars for m in made], "last_tokens": [m.last for m in made]}

        return work

    return map_batches(source, f"id {dict(source.dtypes)['id']}, {STATE}", make).withColumnRenamed("id", id_col)


def edit_prefix_tables(state: DataFrame, edits_col: str = "edits", id_col: str = "doc_id", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """The state after edits, done in turn, with the ids and ``n_computed``, the number of entries that were computed.

    ``edits_col``: array<struct<start:long, stop:long, insert:string>> in
    characters of the text as it stands then; an append is an edit at its end.
    Places outside are clipped; a null list, a null edit or an edit without a
    place changes nothing; a null insert inserts nothing.
    """
    source = state.select(F.col(id_col).alias("id"), "text", "piece_chars", "last_tokens", F.col(edits_col).alias("edits"))
    ranks = ship_file(state.sparkSession, path)

    def make():
        own = TextCoder(ranks.value, pattern)

        def work(rows: dict) -> dict:
            done = []
            for text, chars, last, edits in zip(rows["text"], rows["piece_chars"], rows["last_tokens"], rows["edits"], strict=True):
                now = EditedText(own, text, chars, last)
                for e in edits or []:
                    if e is not None and e["start"] is not None and e["stop"] is not None:
                        now.edit(e["start"], e["stop"], e["insert"] or "")
                done.append(now)
            return {
                "id": rows["id"], "text": [d.text for d in done], "piece_chars": [d.chars for d in done], "last_tokens": [d.last for d in done],
                "ids": [d.ids() for d in done], "n_computed": [d.computed for d in done],
            }

        return work

    schema = f"id {dict(source.dtypes)['id']}, {STATE}, ids array<int>, n_computed long"
    return map_batches(source, schema, make).withColumnRenamed("id", id_col)

"""Fuzzy search for short licence notices.

A notice of k allowed edits is cut into k+1 pieces; whoever holds the notice
with at most k edits holds one piece unchanged. One Aho-Corasick automaton of
all pieces finds the places; the ``regex`` library's bounded-error matching then
verifies each place and says how many edits it took. Everything happens in one
pass over the documents, without a shuffle; notices are a fixed parameter.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import Memo, as_bytes, map_batches

# Phrases that count as base labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices the fuzzy search knows, in lower case, words only.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "licensed under the apache license": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
}

#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 9
#: Answers about windows that a task keeps.
ANSWERS = 20_000

#: Keeps digits, letters and all non-ASCII bytes; A-Z to a-z; the rest to blanks.
WORD_BYTES = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): ``edits + 1`` pieces of nearly equal length."""
        n, parts = len(self.text), self.edits + 1
        cuts = [n * i // parts for i in range(parts + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def make_notices(texts: dict[str, str], chars_per_edit: int) -> list[Notice]:
    return [Notice(t, label, len(t) // chars_per_edit - 1 if len(t) >= 2 * chars_per_edit else 0) for t, label in texts.items()]


class Scanner:
    """The compiled notices; made once per task."""

    def __init__(self, notices: list[Notice], phrases: dict[str, str]):
        self.notices = notices
        self.phrases = [(f" {p} ", label) for p, label in phrases.items()]
        self.exact = [regex.compile(f"(?b)(?:{regex.escape(n.text)}){{e<={n.edits}}}") for n in notices]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for offset, piece in notice.pieces():
                found.setdefault(piece, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, where in found.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()
        self.answers = Memo(self.best, ANSWERS)

    def base(self, padded: str) -> list[tuple[int, str]]:
        """(first word, label) of each place of a phrase in blank-padded words."""
        places = []
        for phrase, label in self.phrases:
            word = seen = 0
            at = padded.find(phrase)
            while at >= 0:
                word += padded.count(" ", seen, at)
                seen = at
                places.append((word, label))
                at = padded.find(phrase, at + 1)
        return places

    def best(self, key: tuple[int, str]) -> tuple[int, int, int] | None:
        """(first character, end, edits) of the best match of a notice in a short window."""
        hit = self.exact[key[0]].search(key[1])
        return None if hit is None else (hit.start(), hit.end(), sum(hit.fuzzy_counts))

    def fuzzy(self, words: str) -> list[tuple[str, int, int, int, int]]:
        """(label, first character, end, edits, notice length) of verified places, best of overlapping ones per notice.

        Each seed opens a window that holds the whole notice with all its edits,
        and no more, so the work grows with the seeds, however long the text is.
        """
        starts: dict[int, array] = {}
        for end, (size, where) in self.seeds.iter(words):
            for i, offset in where:
                starts.setdefault(i, array("q")).append(end + 1 - size - offset)
        out = []
        for i, firsts in starts.items():
            n = self.notices[i]
            last = None
            for start in np.unique(np.frombuffer(firsts, dtype=np.int64)).tolist():
                low = max(0, start - n.edits)
                hit = self.answers[i, words[low : start + len(n.text) + n.edits]]
                if hit is None:
                    continue
                found = (low + hit[0], low + hit[1], hit[2])
                if last is not None and found[0] < last[1]:
                    last = found if found[2] < last[2] else last
                    continue
                if last is not None:
                    out.append((n.label, *last, len(n.text)))
                last = found
            if last is not None:
                out.append((n.label, *last, len(n.text)))
        return sorted(out, key=lambda x: x[1:])

    def scan(self, text: bytes) -> tuple[int, list, list]:
        parts = text.translate(WORD_BYTES).split()
        words = b" ".join(parts).decode("utf-8", "replace")
        return len(parts), self.base(f" {words} "), self.fuzzy(words)


SCHEMA = (
    "n_words long, base array<struct<word:long,label:string>>,"
    " spans array<struct<label:string,start:long,end:long,edits:int,length:int>>"
)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """One row per document: id, words, places of base phrases, verified spans.

    Spans count characters of the text's words in lower case, joined by one
    blank. Null and empty texts give no words and no places; a very long text is
    scanned whole, in time that grows with its length; repeated rows give
    repeated results; a null id is kept; an empty table gives an empty result.
    """
    known = make_notices(NOTICES if notices is None else notices, chars_per_edit)
    base = PHRASES if phrases is None else phrases
    source = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("body"))

    def make():
        scanner = Scanner(known, base)

        def work(rows: dict) -> dict:
            found = [scanner.scan(body) for body in rows["body"]]
            return {
                "id": rows["id"],
                "n_words": [n for n, _, _ in found],
                "base": [[{"word": w, "label": x} for w, x in b] for _, b, _ in found],
                "spans": [[dict(zip(("label", "start", "end", "edits", "length"), s, strict=True)) for s in f] for _, _, f in found],
            }

        return work

    kind = dict(source.dtypes)["id"]
    return map_batches(source, f"id {kind}, {SCHEMA}", make).withColumnRenamed("id", id_col)


def license_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, labels and a score (best share of unedited characters; 1 for a base phrase)."""
    base_labels = F.array_sort(F.array_distinct("base.label"))
    labels = F.array_sort(F.array_distinct(F.concat("base.label", "spans.label")))
    similar = F.transform("spans", lambda s: F.lit(1.0) - s["edits"] / s["length"])
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(similar), F.lit(0.0)))
    return scanned.select(
        id_col,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
    )

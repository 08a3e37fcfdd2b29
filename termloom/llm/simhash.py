"""SimHash fingerprints of word shingles, and near-duplicate groups by a trie join."""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import as_bytes, map_batches
from termloom.llm.components import connected_components
from termloom.llm.trie import trie_links
from termloom.scratch import publish

#: (byte value, bit) -> 0 or 1
BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
BYTE_PLACE = (np.arange(8) * 256).astype(np.int64)


def shingle_hashes(body: bytes, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words in lower case, repeats included; of the whole sequence if it is shorter."""
    words = body.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter([digest(joined[a:b], seed) for a, b in cuts], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; zero for none."""
    n = len(hashes)
    if not n:
        return 0
    seen = np.bincount((hashes.view(np.uint8).reshape(n, 8) + BYTE_PLACE).ravel(), minlength=2048).reshape(8, 256)
    bits = (2 * (seen @ BIT_OF_BYTE) > n).astype(np.uint8)
    return int(np.packbits(bits, axis=1, bitorder="little").ravel().view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) of every row; a text without words has fingerprint zero."""
    source = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("body"))

    def make():
        def work(rows: dict) -> dict:
            fps = np.array([majority(shingle_hashes(b, size)) for b in rows["body"]], dtype=np.uint64)
            return {"id": rows["id"], "fp": fps.view(np.int64)}

        return work

    return map_batches(source, f"id {dict(source.dtypes)['id']}, fp long", make)


def simhash_groups(docs: DataFrame, size: int = 3, budget: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    Rows whose fingerprints differ in at most ``budget`` bits are linked;
    ``component_id`` is the smallest id reachable (null if the whole component
    has null ids only). Equal fingerprints are joined once, so a hot group of
    copies costs one string. Null and empty texts link by fingerprint zero;
    repeated rows each give a row; an empty table gives an empty result.
    """
    fps = publish(fingerprints(docs, size, id_col, text_col), "fingerprints")
    strings = publish(fps.groupBy("fp").agg(F.min("id").alias("least")), "strings")
    links = trie_links(strings.select(F.lit(0).alias("t"), F.col("fp").alias("bits"), F.col("fp").alias("node")), budget)
    roots = connected_components(links).select(F.col("node").alias("fp"), "root")
    rooted = strings.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    named = fps.join(publish(lookup, "groups"), "fp")
    return named.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

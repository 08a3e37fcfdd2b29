"""Near-duplicate groups: SimHash tables, trie self-joins, verified links.

Two texts are near duplicates if the Jaccard similarity of their distinct word
shingles is at least ``similarity``. A SimHash bit of such a pair differs with a
known probability (0.15 at 0.8), so no single fingerprint with a small Hamming
budget would find most pairs. A text therefore has many short fingerprints; in
each table a trie self-join finds those within the budget, and a separate check
word drops chance meetings at once. A first pass takes a few of the pairs that
met, the nearest of each text, and judges them by the shingles. For the second,
texts are dealt into blocks by family. Of every pair that met and isn't
connected by then, one text asks for the other's block, once however many it met
there, and is judged by the shingles against all texts of that block. Texts of
few shingles also meet exactly, by a prefix filter on the shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import as_bytes, map_batches
from termloom.llm.components import connected_components
from termloom.llm.simhash import majority, shingle_hashes
from termloom.llm.substrings import LAST_ID, marked, marks_of
from termloom.llm.trie import Forest, trie_links, trie_meetings
from termloom.scratch import publish

#: Tables of 32 bits, the Hamming budget in each, and the budget in the check word of 64.
#: A pair at similarity 0.8 is met in a table with probability 0.12, so in one of 24 with 0.95; at 0.9 with 0.99.
TABLES, BUDGET, CHECK_BUDGET = 24, 2, 19
WORDS = TABLES // 2 + 1
#: Of them so many are linked first; of the others only links between what those leave apart are made.
FIRST_TABLES = 4
#: Texts of so few shingles meet their partners by shared shingles: ties make their SimHash bits differ more.
FEW = 40
#: Texts of a family in one block, and their bytes, about, when its pairs are judged.
BLOCK_TEXTS, BLOCK_BYTES = 192, 4_000_000
#: Strings of a table in one group of the trie join, about.
GROUP_STRINGS = 1 << 18


def mixed(h: np.ndarray, word: int) -> np.ndarray:
    """Another hash of each hash, for one word of the signature."""
    x = h + np.uint64((0x9E3779B97F4A7C15 * (word + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(base: DataFrame, size: int, similarity: float) -> DataFrame:
    """(ord, md5, sig, few, bytes) of every row of (ord, body); ``few``: the shingles of a text of few, or of one that may be similar to such a text."""
    widest = int(FEW / similarity + 1e-9) if similarity > 0 else FEW

    def make():
        def work(rows: dict) -> dict:
            sigs, few = [], []
            for body in rows["body"]:
                h = np.unique(shingle_hashes(body, size))
                few.append(h.view(np.int64) if len(h) <= widest else None)
                sigs.append(np.array([majority(mixed(h, w)) for w in range(WORDS)], dtype=np.uint64).view(np.int64))
            return {"ord": rows["ord"], "md5": rows["md5"], "sig": sigs, "few": few, "bytes": list(map(len, rows["body"]))}

        return work

    return map_batches(base.select("ord", "body", F.md5("body").alias("md5")), "ord long, md5 string, sig array<long>, few array<long>, bytes long", make)


def jaccard_links(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts (node, body) are similar enough."""
    sided = pairs.join(texts.select(F.col("node").alias("a"), F.col("body").alias("x")), "a")
    sided = sided.join(texts.select(F.col("node").alias("b"), F.col("body").alias("y")), "b").select("a", "b", "x", "y")

    def make():
        def work(rows: dict) -> dict:
            keep = []
            for i, (x, y) in enumerate(zip(rows["x"], rows["y"], strict=True)):
                p, q = set(shingle_hashes(x, size).tolist()), set(shingle_hashes(y, size).tolist())
                if len(p & q) >= similarity * len(p | q):
                    keep.append(i)
            return {c: [rows[c][i] for i in keep] for c in ("a", "b")}

        return work

    return map_batches(sided, "a long, b long", make)


def prefix_keys(nodes: DataFrame, similarity: float) -> DataFrame:
    """(key, node, root) of (node, few, root): shingles of which every two similar texts share one, if one of them has few.

    Two similar sets share one of their first n - ceil(similarity * n) + 1
    shingles in any order of all shingles; the rarest come first here.
    """
    sets = nodes.filter(F.size("few") > 0).select("node", "root", F.size("few").alias("n"), F.explode("few").alias("key"))
    sets = publish(sets, "few")
    times = sets.groupBy("key").agg(F.count("*").alias("times"))
    ordered = sets.join(times, "key").groupBy("node", "root", "n").agg(F.array_sort(F.collect_list(F.struct("times", "key"))).alias("keys"))
    first = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(1e-9)).cast("int") + 1
    kept = ordered.select("node", "root", F.explode(F.slice("keys", F.lit(1), F.least("n", first))).alias("k"))
    return publish(kept.filter("k.times > 1").select(F.col("k.key").alias("key"), "node", "root"), "prefixes")


def families_of(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root, bytes, family): the nodes of connected families that aren't one root yet."""
    families = connected_components(links).withColumnRenamed("root", "family")
    known = publish(nodes.select("node", "root", "bytes").join(families, "node"), "families")
    roots = known.groupBy("family").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return known.join(roots.select("family"), "family", "left_semi")


def linkable(families: DataFrame, bodies: DataFrame, size: int, similarity: float) -> DataFrame:
    """The rows of ``families`` whose text may be similar to another of its family.

    A text with more than 1 - similarity of its shingles in no other text of the
    family can't be. Without it others may stand alone, so this is told again
    while it still drops an eighth of what is left.
    """

    def make():
        def work(rows: dict) -> dict:
            sets = [np.unique(shingle_hashes(body, size)).view(np.int64) for body in rows["body"]]
            sizes = np.array(list(map(len, sets)), dtype=np.int64)
            each = {c: np.repeat(np.array(rows[c], dtype=np.int64), sizes) for c in ("node", "family")}
            return {**each, "n": np.repeat(sizes, sizes), "key": np.concatenate(sets)}

        return work

    texts = families.select("node", "family").join(bodies, "node")
    shingles = publish(map_batches(texts, "node long, family long, n long, key long", make), "shingles")
    left, gone = families, None
    while True:
        before = left.count()
        rest = shingles if gone is None else shingles.join(gone, "node", "left_anti")
        held = rest.groupBy("family", "key").agg(F.count("*").alias("texts"), F.min("node").alias("node"), F.min("n").alias("n"))
        own = held.filter("texts = 1").groupBy("node", "n").agg(F.count("*").alias("own"))
        fresh = own.filter(F.col("n") - F.col("own") < F.col("n") * F.lit(similarity) - F.lit(1e-9)).select("node")
        gone = publish(fresh if gone is None else gone.union(fresh), "alone")
        left = families.join(gone, "node", "left_anti")
        if (before - left.count()) * 8 <= before:
            return left


def blocks_of(known: DataFrame) -> DataFrame:
    """(node, root, bytes, block): the rows of (node, root, bytes, family), dealt into blocks of bounded texts and bytes."""
    parts = known.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("bytes") / BLOCK_BYTES)).alias("n"))
    block = F.xxhash64("family", F.expr("pmod(xxhash64(node, 1), n)"))
    return publish(known.join(parts, "family").select("node", "root", "bytes", block.alias("block")), "blocks")


def few_meetings(keyed: DataFrame, blocks: DataFrame) -> DataFrame:
    """(node, block): the blocks that hold a text of another root with one of the node's keys."""
    placed = keyed.join(blocks.select("node", "block"), "node")
    held = placed.groupBy("key", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    met = keyed.join(held, "key").filter((F.col("low") != F.col("root")) | (F.col("high") != F.col("root")))
    return met.select("node", "block").distinct()


def block_links(asked: DataFrame, blocks: DataFrame, bodies: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links (a, b) that connect the nodes asked for with the similar texts of other roots in the block they ask.

    Nodes of one block that ask the same block are judged together: a text
    travels once per pair of blocks, and a task holds two blocks at most. Of
    their links those are told that join what others of them leave apart.
    """
    own = blocks.select("node", F.col("block").alias("own"))
    placed = publish(asked.join(own, "node").select(F.xxhash64("own", "block").alias("cell"), "node", "block"), "placed")
    members = placed.select("cell", "block").distinct().join(blocks.select("block", "node"), "block")
    sides = placed.select("cell", "node", F.lit(True).alias("asks")).unionByName(members.select("cell", "node", F.lit(False).alias("asks")))
    each = sides.groupBy("cell", "node").agg(F.max("asks").alias("asks"), F.max(~F.col("asks")).alias("held"))
    sent = each.join(blocks.select("node", "root"), "node").join(bodies, "node")

    def judge(pdf):
        import pandas as pd

        sets = [np.unique(shingle_hashes(bytes(x), size)) for x in pdf["body"]]
        sizes = np.array(list(map(len, sets)))
        node, root = pdf["node"].to_numpy(), pdf["root"].to_numpy()
        held = np.flatnonzero(pdf["held"].to_numpy() & (sizes > 0))
        forest = Forest(len(node))
        _, first, of = np.unique(root, return_index=True, return_inverse=True)
        forest.parent = first[of].tolist()
        if len(held):
            hashes = np.concatenate([sets[i] for i in held])
            owner = np.repeat(held, sizes[held])
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            for i in np.flatnonzero(pdf["asks"].to_numpy() & (sizes > 0)).tolist():
                low, high = np.searchsorted(hashes, sets[i]), np.searchsorted(hashes, sets[i], side="right")
                n = high - low
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                both = np.bincount(owner[at], minlength=len(sets))
                near = np.flatnonzero((both > 0) & (root != root[i]) & (both >= similarity * (sizes + sizes[i] - both)))
                if len(near):
                    _, one = np.unique(root[near], return_index=True)
                    forest.add(np.full(len(one), i), near[one])
        ends = np.array(forest.links, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": node[ends[:, 0]], "b": node[ends[:, 1]]}, dtype="int64")

    return sent.groupBy("cell").applyInPandas(judge, "a long, b long")


def bodies_of(base: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, body) of the nodes in ``wanted``."""
    asked = wanted.select("node").distinct().join(nodes.select("node", "md5"), "node")
    bodies = base.select(F.md5("body").alias("md5"), "body").join(asked, "md5").dropDuplicates(["node"])
    return publish(bodies.select("node", "body"), "bodies")


def tables_of(nodes: DataFrame, *more: str) -> DataFrame:
    """(t, bits, node, check) of each node (node, sig) in every table."""
    bits = F.when(F.col("t") % 2 == 1, F.col("w").bitwiseAND(F.lit(-(1 << 32)))).otherwise(F.shiftleft("w", 32))
    tables = nodes.select("node", "sig", *more, F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))).alias("t"))
    return tables.withColumn("w", F.element_at("sig", F.shiftright("t", 1) + 1)).select(
        "t", bits.alias("bits"), "node", F.element_at("sig", WORDS).alias("check"), *more
    )


def all_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes (node, sig) that meet in some table.

    A group of n near copies would make up to n - 1 links in every table; those of
    the first few connect most of it, and the other tables add what they leave apart.
    """
    strings = publish(tables_of(nodes), "strings")
    some = publish(trie_links(strings.filter(F.col("t") < FIRST_TABLES), BUDGET, GROUP_STRINGS, 1, CHECK_BUDGET), "links")
    known = nodes.select("node", "sig").join(connected_components(some), "node", "left").withColumn("root", F.coalesce("root", "node"))
    others = publish(tables_of(known, "root").filter(F.col("t") >= FIRST_TABLES), "strings")
    rest = trie_links(others, BUDGET, GROUP_STRINGS, 1, CHECK_BUDGET, rooted=True)
    return publish(some.union(rest).distinct(), "links")


def near_duplicate_groups(base: DataFrame, size: int, similarity: float) -> DataFrame:
    """(ord, md5, times, root): the distinct (ord, text) of ``base`` (ord, body), how often each stands, its group."""
    rows = publish(signatures(base, size, similarity).withColumn("row", F.monotonically_increasing_id()), "signatures")
    texts = publish(rows.groupBy("md5").agg(F.min("row").alias("node")), "texts")
    nodes = publish(rows.select(F.col("row").alias("node"), "md5", "sig", "few", "bytes").join(texts.select("node"), "node", "left_semi"), "nodes")
    links = all_links(nodes)
    sigs = nodes.select("node", "sig")
    met = links.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a")
    met = met.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b")
    apart = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, d: n + d)
    nearest = met.groupBy("b").agg(F.min(F.struct(apart.alias("apart"), "a")).alias("to")).select("to.a", "b")
    nearest = publish(nearest, "nearest")
    first = publish(jaccard_links(nearest, bodies_of(base, nodes, nearest.select(F.explode(F.array("a", "b")).alias("node"))), size, similarity), "first")
    known = publish(connected_components(first), "known")
    rooted = nodes.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = publish(rooted, "rooted")
    keyed = prefix_keys(rooted, similarity)
    stars = keyed.join(keyed.groupBy("key").agg(F.min("node").alias("a")), "key").select("a", F.col("node").alias("b")).filter("a <> b")
    families = publish(families_of(links.select("a", "b").unionByName(stars), rooted), "families")
    bodies = bodies_of(base, nodes, families)
    blocks = blocks_of(linkable(families, bodies, size, similarity))
    strings = tables_of(nodes.select("node", "sig").join(blocks.select("node", "root", "block"), "node"), "root", "block")
    asked = trie_meetings(strings, BUDGET, CHECK_BUDGET, GROUP_STRINGS, 1).union(few_meetings(keyed, blocks))
    asked = publish(asked.distinct(), "asked")
    held = publish(block_links(asked, blocks, bodies, size, similarity), "held")
    groups = connected_components(first.unionByName(held))
    ends = texts.join(groups, "node", "left").select("md5", F.coalesce("root", "node").alias("root"))
    return rows.groupBy("ord", "md5").agg(F.count("*").alias("times")).join(ends, "md5")


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest id (null last), then by the text's md5.

    Similarity is that of the distinct shingles of ``size`` words in lower case
    (a shorter text is one shingle); groups are connected by links, so two rows
    of a group may be less similar. Texts without words, null ones included, are
    one group. Rows with the same id and text count as one. Rows to drop are
    told apart by a bitmap of fixed size and, where that marks a row, by an
    exact join, so most texts are never shuffled.
    """
    spark = docs.sparkSession
    order, body = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)), as_bytes(f"`{text_col}`")
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    base = docs.select(order.alias("ord"), body.alias("body"))
    groups = publish(near_duplicate_groups(base, size, similarity), "groups")
    first = groups.groupBy("root").agg(F.min(F.struct("ord", "md5")).alias("first"))
    judged = groups.join(first, "root").select(
        "ord", "md5", "times", (F.struct("ord", "md5") == F.col("first")).alias("stays"), F.xxhash64("ord", "md5").alias("mark")
    )
    special = publish(judged.filter("NOT stays OR times > 1"), "special")
    marks = spark.sparkContext.broadcast(marks_of(special, "mark"))
    keyed = docs.select(row, order.alias("ord"), F.md5(body).alias("md5")).withColumn("mark", F.xxhash64("ord", "md5"))

    def only(want: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(marked(marks.value, batch.column("mark").to_numpy().view(np.uint64)) == want))

        return run

    plain = keyed.mapInArrow(only(False), keyed.schema)
    suspects = keyed.mapInArrow(only(True), keyed.schema).join(special.select("ord", "md5", "stays", "times"), ["ord", "md5"], "left")
    stay = suspects.filter("stays IS NULL OR stays")
    once = stay.filter("times > 1").dropDuplicates(["ord", "md5"])
    rest = stay.filter("times IS NULL OR times = 1")
    return plain.select("row").unionAll(rest.select("row")).unionAll(once.select("row")).select("row.*")

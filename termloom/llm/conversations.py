"""Prefix trie of conversations, by double arrays per shard.

A conversation becomes the list of the 16-byte digests of its turns. Equal
lists are one sequence, with the number and the smallest id of its members.
Sequences are sorted and dealt into shards of bounded size by ranges, so a shard
holds neighbours that share prefixes, however common a first turn is.

A shard numbers its turns densely and packs its trie into two arrays: the child
of node ``s`` by turn ``c`` stands at ``t = BASE[s] + c``, and ``CHECK[t] = s``.
All sequences then walk the arrays together, leaving their members at the nodes,
and sums over subtrees run along CHECK from the deepest level up.

Only nodes on the path of a shard's first or last sequence can reach into other
shards. Those are handed on as partial aggregates and merged globally by node;
what the merged nodes add to the sums of their ancestors runs along one path
through each of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termloom.operators.lookups import lookup_join
from termloom.scratch import publish

DIGEST = 16
#: Turns that a shard should hold, and conversation ids (a range of that width) that one row may list.
SHARD_TURNS = 200_000
ID_RANGE = 4_096
#: Turns that a conversation may take from its model.
HEAD = 5
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_lists(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): the digest and the length (code points) of each turn, in the order of turn (null first), role and text.

    A null role or text is empty. Rows without a conversation id belong to no
    conversation and take no part. Repeated rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # Digests order nothing: places come from a window whose sort may spill.
    own = turns.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    digest = F.md5(F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text")).cast("binary"))
    placed = own.select("conv_id", F.struct(place.alias("place"), digest.alias("digest"), F.length("text").alias("chars")).alias("turn"))
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt_conversations(lists: DataFrame, model: Column, head: Column) -> DataFrame:
    """(conv_id, turns) with the first ``head`` turns taken from the conversation ``model``, none if it is absent.

    Both are expressions over ``conv_id``; ``head`` is at most ``HEAD``.
    """
    lists = publish(lists, "turn_lists")
    named = lists.select("conv_id", "turns", model.alias("model"), head.cast("int").alias("head"))
    wanted = named.select(F.col("model")).distinct()
    heads = lists.select(F.col("conv_id").alias("model"), F.slice("turns", 1, HEAD).alias("given")).join(wanted, "model", "left_semi")
    joined = named.join(heads, "model", "left")
    given = F.when(F.col("given").isNull() | (F.col("head") == 0), F.slice("turns", 1, 0)).otherwise(F.slice("given", 1, F.col("head")))
    rest = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(given, rest).alias("turns"))


def batches_of(df: DataFrame, run, schema: str) -> DataFrame:
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(work, schema)


def distinct_sequences(rebuilt: DataFrame) -> DataFrame:
    """(key, chars, members, conv_id, ends): each distinct list of turns, its members' number, smallest id and hashed ids.

    Members are first listed in id ranges of bounded width, then a task reads the
    ranges of a key in order and hashes as it reads; it never holds them all.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    chars = F.transform("turns", lambda t: t["chars"])
    low = F.col("conv_id") - F.pmod("conv_id", F.lit(ID_RANGE))
    listed = rebuilt.select("conv_id", key.alias("key"), chars.alias("chars"), low.alias("low")).groupBy("key", "low").agg(
        F.first("chars").alias("chars"), F.count("*").alias("members"), F.min("conv_id").alias("conv_id"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )

    def run(batches):
        open_key, row, ends = None, None, None
        for batch in batches:
            done = []
            for part in batch.to_pylist():
                if row is None or part["key"] != open_key:
                    if row is not None:
                        done.append({**row, "ends": ends.hexdigest()})
                    open_key, row, ends = part["key"], part, hashlib.sha256(part["ids"].encode())
                else:
                    row["members"] += part["members"]
                    ends.update(b"," + part["ids"].encode())
            if done:
                yield {c: [d[c] for d in done] for c in ("key", "chars", "members", "conv_id", "ends")}
        if row is not None:
            yield {c: [v] for c, v in {**row, "ends": ends.hexdigest()}.items()}

    ordered = listed.repartition("key").sortWithinPartitions("key", "low")
    return batches_of(ordered, run, "key binary, chars array<int>, members long, conv_id long, ends string")


class DoubleArray:
    """A trie over sorted, distinct sequences of dense turn ids (from 1), packed into BASE and CHECK.

    Slots of children are searched upwards from the first free slot, for nodes
    with one child that slot itself; BASE may be negative.
    """

    def __init__(self, sequences: list[list[int]]):
        self.base, self.check, self.used = [0], [0], bytearray(b"\1")
        free, todo = 1, [(0, 0, len(sequences), 0)]
        while todo:
            node, low, high, depth = todo.pop()
            low += len(sequences[low]) == depth  # a sequence that ends here comes first
            groups, at = [], low
            for turn, same in groupby(sequences[i][depth] for i in range(low, high)):
                n = sum(1 for _ in same)
                groups.append((turn, at, at + n))
                at += n
            if not groups:
                continue
            while free < len(self.used) and self.used[free]:
                free += 1
            codes = [g[0] for g in groups]
            least = min(codes)
            first = free
            while any(0 < (t := first + c - least) < len(self.used) and self.used[t] for c in codes):
                first += 1
            self.base[node] = first - least
            for turn, start, stop in groups:
                slot = self.base[node] + turn
                grow = slot + 1 - len(self.used)
                if grow > 0:
                    self.base += [0] * grow
                    self.check += [-1] * grow
                    self.used += bytes(grow)
                self.check[slot], self.used[slot] = node, 1
                todo.append((slot, start, stop, depth + 1))

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.base, dtype=np.int64), np.array(self.check, dtype=np.int64)


def dense_ids(digests: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
    """The sequences' turns numbered from 1 as they are met, the depths one after the other, so that siblings get close numbers."""
    depth = np.concatenate([np.arange(n) for n in lengths]) if len(digests) else np.zeros(0, dtype=np.int64)
    order = np.argsort(depth, kind="stable")
    _, first, inverse = np.unique(digests[order], return_index=True, return_inverse=True)
    rank = np.empty(len(first), dtype=np.int64)
    rank[np.argsort(first)] = np.arange(1, len(first) + 1)
    codes = np.empty(len(digests), dtype=np.int64)
    codes[order] = rank[inverse]
    return [part.tolist() for part in np.split(codes, np.cumsum(lengths)[:-1])]


NODE = "depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"
SHARD_SCHEMA = f"{NODE}, parent_conv_id long, chars long, node binary, parent binary, path long"


def path_names(key: bytes) -> list[bytes]:
    """A name for each prefix of a sequence, the empty one first: the md5 of the digests so far."""
    names, state = [], hashlib.md5()
    for at in range(0, len(key) + 1, DIGEST):
        names.append(state.digest())
        state.update(key[at : at + DIGEST])
    return names


def shard_nodes(rows: list[dict], shard: int) -> dict[str, list]:
    """The nodes of one shard.

    Nodes that lie in this shard alone are complete, but for the id of a parent
    that does not (``parent`` names it). Nodes on the first and the last path
    have a name and a path and hold this shard's part only, without their own
    share in sums; a node on both paths brings its part on the first.
    """
    rows.sort(key=lambda r: r["key"])
    lengths = np.array([len(r["chars"]) for r in rows])
    digests = np.frombuffer(b"".join(r["key"] for r in rows), dtype=f"V{DIGEST}")
    codes = dense_ids(digests, lengths)
    base, check = DoubleArray(codes).arrays()
    members = np.array([r["members"] for r in rows])
    ids = np.array([r["conv_id"] for r in rows])
    n_convs, conv = np.zeros(len(base), dtype=np.int64), np.full(len(base), np.iinfo(np.int64).max)
    depth, chars = np.full(len(base), -1), np.zeros(len(base), dtype=np.int64)
    ends: dict[int, str] = {}
    at, live, levels = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows)), []
    for level in range(int(lengths.max()) + 1):
        np.add.at(n_convs, at[live], members[live])
        np.minimum.at(conv, at[live], ids[live])
        levels.append(np.unique(at[live]))
        depth[levels[-1]] = level
        over = lengths[live] == level
        for i in live[over].tolist():
            ends[int(at[i])] = rows[i]["ends"]
        live = live[~over]
        if len(live):
            turn = np.array([codes[i][level] for i in live.tolist()])
            child = base[at[live]] + turn
            if (check[child] != at[live]).any():
                raise AssertionError("a sequence is not in its own trie")
            at[live] = child
            chars[child] = [rows[i]["chars"][level] for i in live.tolist()]
    paths = []
    for i in (0, len(rows) - 1):
        slots = [0]
        for turn in codes[i]:
            slots.append(int(base[slots[-1]]) + turn)
        paths.append(slots)
    shared = np.zeros(len(base), dtype=bool)
    for slots in paths:
        shared[slots] = True
    children, leaves = np.zeros(len(base), dtype=np.int64), np.zeros(len(base), dtype=np.int64)
    saved = np.where(shared | (depth < 0), 0, (n_convs - 1) * chars)
    for slots in reversed(levels):
        own = slots[~shared[slots] & (children[slots] == 0)]
        leaves[own] = 1
        below = slots[slots > 0]
        np.add.at(children, check[below], np.where(shared[below], 0, 1))
        # A shared child is left out of the children, but what lies under it counts.
        np.add.at(leaves, check[below], leaves[below])
        np.add.at(saved, check[below], saved[below])
    names = {}
    for i, slots in zip((0, len(rows) - 1), paths, strict=True):
        names |= dict(zip(slots, path_names(rows[i]["key"]), strict=True))
    alone = np.flatnonzero((depth >= 0) & ~shared)
    parents = check[alone]
    out = {
        "depth": depth[alone].tolist(), "conv_id": conv[alone].tolist(), "n_convs": n_convs[alone].tolist(), "n_children": children[alone].tolist(),
        "n_leaves": leaves[alone].tolist(), "saved": saved[alone].tolist(), "ends": [ends.get(s, NO_ENDS) for s in alone.tolist()],
        "parent_conv_id": [None if shared[p] else int(conv[p]) for p in parents.tolist()], "chars": chars[alone].tolist(),
        "node": [None] * len(alone), "parent": [names.get(p) if shared[p] else None for p in parents.tolist()], "path": [None] * len(alone),
    }
    given: set[int] = set()
    for side, slots in enumerate(paths):
        for s in slots:
            part = s not in given
            given.add(s)
            row = {
                "depth": int(depth[s]), "conv_id": int(conv[s]) if part else None, "n_convs": int(n_convs[s]) if part else 0,
                "n_children": int(children[s]) if part else 0, "n_leaves": int(leaves[s]) if part else 0, "saved": int(saved[s]) if part else 0,
                "ends": ends.get(s) if part else None, "parent_conv_id": None, "chars": int(chars[s]), "node": names[s],
                "parent": names[int(check[s])] if s else None, "path": 2 * shard + side,
            }
            for c, v in row.items():
                out[c].append(v)
    return out


def shard_tables(sequences: DataFrame, shard_turns: int) -> DataFrame:
    turns = sequences.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    dealt = sequences.repartitionByRange(int(turns // shard_turns) + 1, "key").withColumn("shard", F.spark_partition_id())

    def run(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        if rows:
            yield shard_nodes(rows, rows[0]["shard"])

    return batches_of(dealt, run, SHARD_SCHEMA)


def merged_nodes(parts: DataFrame) -> DataFrame:
    """The nodes that several shards may hold, whole: (node, parent, and the columns of a node, parent_conv_id included)."""
    merged = parts.groupBy("node").agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("alone"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"), F.max("parent").alias("parent"),
        F.max("chars").alias("chars"), F.min("path").alias("through"),
    )
    merged = publish(merged, "shared_nodes")
    shared_children = merged.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    merged = merged.join(shared_children, "node", "left").withColumn("n_children", F.col("alone") + F.coalesce("more", F.lit(0)))
    merged = publish(merged.drop("alone", "more"), "shared_nodes")
    # Each node counts on one of its paths, for itself and for the nodes above it there.
    own = merged.select("node", "through", ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"), (F.col("n_children") == 0).cast("long").alias("own_leaf"))
    on_path = parts.select("node", "path", "depth").join(own, "node")
    upward = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.col("path") == F.col("through")
    carried = on_path.select("node", *[F.sum(F.when(here, F.col(c)).otherwise(F.lit(0))).over(upward).alias(c) for c in ("own_saved", "own_leaf")])
    carried = carried.groupBy("node").agg(F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = merged.join(carried, "node").join(above, "parent", "left")
    return whole.select(
        "node", "depth", "conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("own_leaf")).alias("n_leaves"),
        (F.col("saved") + F.col("own_saved")).alias("saved"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"), "parent_conv_id",
    )


def prefix_trie(rebuilt: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie over (conv_id, turns), as ``turn_lists`` gives them.

    Per node: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens (over the subtree, members
    but one times the length of the node's last text) and ends_sha256 (ids of the
    members that end there, in order, joined by commas). Without conversations
    there is no node. A conversation without turns ends at the root.

    One conversation's turns travel as one row of digests, 16 bytes a turn, so
    memory is bounded by the longest conversation and by the shard size.
    """
    sequences = publish(distinct_sequences(rebuilt), "sequences")
    nodes = publish(shard_tables(sequences, shard_turns), "shards")
    shared = publish(merged_nodes(nodes.filter("node is not null")), "shared_nodes")
    alone = nodes.filter("node is null")
    names = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends", "parent_conv_id"]
    above = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    under = lookup_join(alone.filter("parent is not null").select(*names[:-1], "parent"), above, ["parent"])
    whole = alone.filter("parent is null").select(*names).unionByName(under.select(*names[:-1], F.col("above").alias("parent_conv_id")))
    return whole.unionByName(shared.select(*names)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")
    )

"""Self-join of bit strings within a Hamming budget by a binary trie.

Pairs of trie nodes are visited together from (root, root): each step goes one
bit down on both sides, adds one to the differing bits where the bits differ,
and drops the pair once the budget is exceeded. The upper part of the walk runs
on node counts alone and ends where two nodes together are small enough for a
task; each such pair of nodes is then one group, walked on by numpy over sorted
arrays. So a group is bounded by ``limit`` rows unless more strings than that
share their first ``TOP_BITS`` bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import map_batches

#: Bits that the walk over counts may go down; at most 2**TOP_BITS counts a table.
TOP_BITS = 14
#: The walk over counts goes down so many bits at least, for enough groups.
LEAST_BITS = 4
#: Two nodes of so many strings together are one group.
GROUP_ROWS = 1 << 15
#: Node pairs held at once in a task.
FRONTIER = 1 << 16
#: A node pair with so many string pairs at most is compared string by string.
DIRECT = 8
#: String pairs compared at once in a task.
PAIRS = 1 << 20


def walk_counts(counts: dict[int, int], budget: int, limit: int, least: int, top: int) -> list[tuple[int, int, int, int]]:
    """(depth, u, v, differing bits) of the node pairs, u <= v, at which the walk over counts ends."""
    levels = [dict(counts)]
    for _ in range(top):
        up: dict[int, int] = {}
        for node, n in levels[-1].items():
            up[node >> 1] = up.get(node >> 1, 0) + n
        levels.append(up)
    levels.reverse()  # levels[d]: counts of nodes at depth d
    done, walk = [], [(0, 0, 0, 0)] if levels[0] else []
    while walk:
        d, u, v, diff = walk.pop()
        size = levels[d][u] + (levels[d][v] if u != v else 0)
        if d == top or d >= least and size <= limit:
            done.append((d, u, v, diff))
            continue
        below = levels[d + 1]
        for x in (0, 1):
            for y in (0, 1):
                s, t, far = 2 * u + x, 2 * v + y, diff + (x != y)
                if (u != v or s <= t) and far <= budget and s in below and t in below:
                    walk.append((d + 1, s, t, far))
    return sorted(done)


def pieces(nodes: np.ndarray):
    """Node pairs [a0, a1, b0, b1, ...] in parts of about PAIRS string pairs; a larger one is cut by its left rows."""
    wide = nodes[:, 3] - nodes[:, 2]
    step = np.maximum(1, PAIRS // wide)
    cuts = -(-(nodes[:, 1] - nodes[:, 0]) // step)
    at = np.repeat(np.arange(len(nodes)), cuts)
    k = np.arange(len(at)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    out = nodes[at]
    out[:, 0] += k * step[at]
    out[:, 1] = np.minimum(out[:, 1], out[:, 0] + step[at])
    part = np.cumsum((out[:, 1] - out[:, 0]) * wide[at]) // PAIRS
    yield from np.split(out, np.flatnonzero(np.diff(part)) + 1)


def join_nodes(left: np.ndarray, right: np.ndarray | None, depth: int, diff: int, budget: int):
    """Yield (i, j) index arrays of strings within the budget; ``right`` None: pairs i < j of ``left``.

    The arrays are sorted uint64; all strings of one side share their first
    ``depth`` bits, and the two sides differ in ``diff`` of them.
    """
    same = right is None
    right = left if same else right
    zeros = {}

    def middle(side: int, values: np.ndarray, bit: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if (side, bit) not in zeros:
            off = ((values >> np.uint64(bit)) & np.uint64(1)) == 0
            zeros[side, bit] = np.concatenate([[0], np.cumsum(off)])
        z = zeros[side, bit]
        return lo + z[hi] - z[lo]

    first = np.array([[0, len(left), 0, len(right), diff, depth]], dtype=np.int64)
    stack = [first] if len(left) and len(right) else []
    while stack:
        nodes = stack.pop()
        if len(nodes) > FRONTIER:
            half = len(nodes) // 2
            stack += [nodes[:half], nodes[half:]]
            continue
        a0, a1, b0, b1, far, d = nodes.T
        d = int(d[0])
        direct = ((a1 - a0) * (b1 - b0) <= DIRECT) if d < 64 else np.ones(len(nodes), dtype=bool)
        if direct.any():
            for small in pieces(nodes[direct]):
                wide = small[:, 3] - small[:, 2]
                each = (small[:, 1] - small[:, 0]) * wide
                at = np.repeat(np.arange(len(small)), each)
                k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                i, j = small[at, 0] + k // wide[at], small[at, 2] + k % wide[at]
                near = np.bitwise_count(left[i] ^ right[j]) <= budget
                if same:
                    near &= i < j
                if near.any():
                    yield i[near], j[near]
        if direct.all():
            continue
        a0, a1, b0, b1, far, _ = nodes[~direct].T
        bit = 63 - d
        am, bm = middle(0, left, bit, a0, a1), middle(1, right, bit, b0, b1)
        below = []
        for p, q in ((a0, am), (am, a1)):
            for r, s in ((b0, bm), (bm, b1)):
                more = far + ((p is am) != (r is bm))
                keep = (p < q) & (r < s) & (more <= budget)
                if same:
                    keep &= p <= r  # a node is met with itself and with nodes to its right
                below.append(np.stack([p, q, r, s, more, np.full(len(p), d + 1)], axis=1)[keep])
        below = np.concatenate(below)
        if len(below):
            stack.append(below)


class Forest:
    """Union-find over the rows of a task; keeps the links that joined two sets."""

    def __init__(self, n: int):
        self.parent, self.links = list(range(n)), []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def add(self, i: np.ndarray, j: np.ndarray, block: int = 1 << 16) -> None:
        for at in range(0, len(i), block):
            root = np.array(self.parent)
            while not np.array_equal(root, root[root]):
                root = root[root]
            x, y = i[at : at + block], j[at : at + block]
            apart = root[x] != root[y]
            for s, t in zip(x[apart].tolist(), y[apart].tolist(), strict=True):
                u, v = self.find(s), self.find(t)
                if u != v:
                    self.parent[max(u, v)] = min(u, v)
                    self.links.append((s, t))


def dealt(strings: DataFrame, more: list[str], budget: int, limit: int, least: int):
    """(g, side, bits, node, and ``more`` long columns): the strings in the groups of the walk; and a broadcast of each group's node pair."""
    spark = strings.sparkSession
    head = F.shiftrightunsigned("bits", 64 - TOP_BITS).cast("int")
    counts: dict[int, dict[int, int]] = {}
    for r in strings.groupBy("t", head.alias("head")).count().collect():  # at most 2**TOP_BITS a table
        counts.setdefault(r["t"], {})[r["head"]] = r["count"]
    plan = [(t, *x) for t in sorted(counts) for x in walk_counts(counts[t], budget, limit, least, TOP_BITS)]
    sides: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for g, (t, d, u, v, _) in enumerate(plan):
        sides.setdefault((t, d), []).append((u, g, 0))
        if u != v:
            sides.setdefault((t, d), []).append((v, g, 1))
    lookup = {key: np.array(sorted(rows), dtype=np.int64) for key, rows in sides.items()}
    shared = spark.sparkContext.broadcast(lookup)
    columns = ["t", "bits", "node", *more]

    def make():
        tables = shared.value

        def work(rows: dict) -> dict:
            t = np.array(rows["t"], dtype=np.int64)
            bits = np.array(rows["bits"], dtype=np.int64).view(np.uint64)
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for (table, d), known in tables.items():
                mine = np.flatnonzero(t == table)
                heads = (bits[mine] >> np.uint64(64 - d)).astype(np.int64) if d else np.zeros(len(mine), dtype=np.int64)
                lo, hi = np.searchsorted(known[:, 0], heads), np.searchsorted(known[:, 0], heads, side="right")
                row = np.repeat(np.arange(len(mine)), hi - lo)
                at = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
                out.append((mine[row], known[at, 1:]))
            row = np.concatenate([x[0] for x in out]) if out else np.zeros(0, dtype=np.int64)
            where = np.concatenate([x[1] for x in out]) if out else np.zeros((0, 2), dtype=np.int64)
            made = {"g": where[:, 0], "side": where[:, 1], "bits": bits.view(np.int64)[row], "node": np.array(rows["node"], dtype=np.int64)[row]}
            return made | {c: np.array(rows[c], dtype=np.int64)[row] for c in more}

        return work

    schema = "g int, side int, bits long, node long" + "".join(f", {c} long" for c in more)
    spread = map_batches(strings.select(*columns), schema, make)
    nodes_of = spark.sparkContext.broadcast([(d, u, v, diff) for _, d, u, v, diff in plan])
    return spread, nodes_of


def trie_links(strings: DataFrame, budget: int, limit: int = GROUP_ROWS, least: int = LEAST_BITS, check_budget: int | None = None, rooted: bool = False) -> DataFrame:
    """Links (a, b) between nodes whose strings differ in at most ``budget`` bits.

    ``strings``: (t int, bits long, node long), and (check long) if
    ``check_budget`` is given; strings of different ``t`` never meet. Links are
    thinned inside a group to those that connect it (nearest first), so every
    two linked nodes stay connected, and a dense group of n makes n - 1 links.
    With a check word, a pair must also keep to ``check_budget`` in it, and of
    rows with equal bits only leaders go on: a row within that budget of an
    earlier leader is linked to it. ``rooted`` strings also have (root long): nodes
    of one root are connected already, and links between them are left out.
    """
    checked = check_budget is not None
    more = [c for c, wanted in (("check", checked), ("root", rooted)) if wanted]
    spread, nodes_of = dealt(strings, more, budget, limit, least)

    def solve(pdf):
        import pandas as pd

        depth, u, v, diff = nodes_of.value[int(pdf["g"].iloc[0])]
        bits = pdf["bits"].to_numpy().view(np.uint64)
        check = pdf["check"].to_numpy().view(np.uint64) if checked else None
        order = np.lexsort((pdf["node"].to_numpy(), bits, pdf["side"].to_numpy()))
        bits, node, side = bits[order], pdf["node"].to_numpy()[order], pdf["side"].to_numpy()[order]
        forest = Forest(len(bits))
        if rooted:
            _, first, of = np.unique(pdf["root"].to_numpy()[order], return_index=True, return_inverse=True)
            forest.parent = first[of].tolist()
        lead = np.ones(len(bits), dtype=bool)
        if checked:
            check = check[order]
            cuts = np.flatnonzero(np.concatenate([[True], (bits[1:] != bits[:-1]) | (side[1:] != side[:-1])]))
            for at, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bits)], strict=True):
                if end - at > 1:
                    left = np.arange(at, end)
                    lead[left] = False
                    while len(left):
                        lead[left[0]] = True
                        near = np.bitwise_count(check[left] ^ check[left[0]]) <= check_budget
                        if u == v or depth == 0:  # the same pairs come up where a node is met with itself
                            forest.add(np.full(near.sum() - 1, left[0]), left[near][1:])
                        left = left[~near]
        kept = np.flatnonzero(lead)
        cut = np.searchsorted(side[kept], 1)
        found = list(join_nodes(bits[kept[:cut]], None if u == v else bits[kept[cut:]], depth, diff, budget))
        if found:
            i = kept[:cut][np.concatenate([x[0] for x in found])]
            j = (kept[:cut] if u == v else kept[cut:])[np.concatenate([x[1] for x in found])]
            far = np.bitwise_count(bits[i] ^ bits[j]).astype(np.int64)
            if checked:
                apart = np.bitwise_count(check[i] ^ check[j]).astype(np.int64)
                i, j, far = i[apart <= check_budget], j[apart <= check_budget], (far + apart)[apart <= check_budget]
            nearest = np.argsort(far, kind="stable")
            forest.add(i[nearest], j[nearest])
        ends = np.array(forest.links, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": node[ends].min(axis=1), "b": node[ends].max(axis=1)})

    return spread.groupBy("g").applyInPandas(solve, "a long, b long").distinct()


def met_pairs(column: dict[str, np.ndarray], plan: tuple, budget: int, check_budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (x, y) of the strings of one group that keep to both budgets and have different roots, in parts of bounded size.

    Strings with equal bits and root are walked as one.
    """
    depth, u, v, diff = plan
    order = np.lexsort((column["node"], column["root"], column["bits"].view(np.uint64), column["side"]))
    side, root = column["side"][order], column["root"][order]
    bits, check = (column[c][order].view(np.uint64) for c in ("bits", "check"))
    new = np.ones(len(bits), dtype=bool)
    new[1:] = (bits[1:] != bits[:-1]) | (side[1:] != side[:-1]) | (root[1:] != root[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(bits))
    cut = np.searchsorted(side[first], 1)
    right = first[:cut] if u == v else first[cut:]
    shift = 0 if u == v else cut
    for i, j in join_nodes(bits[first[:cut]], None if u == v else bits[right], depth, diff, budget):
        j = j + shift
        apart = root[first[i]] != root[first[j]]
        i, j = i[apart], j[apart]
        for part in pieces(np.stack([first[i], last[i], first[j], last[j]], axis=1)) if len(i) else ():
            wide = part[:, 3] - part[:, 2]
            each = (part[:, 1] - part[:, 0]) * wide
            at = np.repeat(np.arange(len(part)), each)
            k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            x, y = part[at, 0] + k // wide[at], part[at, 2] + k % wide[at]
            near = np.bitwise_count(check[x] ^ check[y]) <= check_budget
            if near.any():
                yield order[x[near]], order[y[near]]


def trie_pairs(strings: DataFrame, budget: int, check_budget: int, limit: int = GROUP_ROWS, least: int = LEAST_BITS) -> DataFrame:
    """All pairs (a, b), a < b, of nodes of different ``root`` that keep to both budgets in some table.

    ``strings``: (t int, bits long, node long, check long, root long). Nothing
    is thinned but what ``root`` says is connected already.
    """
    spread, nodes_of = dealt(strings, ["check", "root"], budget, limit, least)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        column = {c: rows.column(c).to_numpy() for c in rows.column_names}
        for x, y in met_pairs(column, nodes_of.value[int(column["g"][0])], budget, check_budget):
            x, y = column["node"][x], column["node"][y]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return spread.groupBy("g").applyInArrow(solve, "a long, b long").distinct()


def trie_meetings(strings: DataFrame, budget: int, check_budget: int, limit: int = GROUP_ROWS, least: int = LEAST_BITS) -> DataFrame:
    """(node, block): for every pair of ``trie_pairs`` its smaller node and the ``block`` of the other, each once.

    ``strings`` also has (block long). A group of the walk tells a pair of blocks
    in one row with the nodes that met, however often they met; a node that met a
    block in many tables is told once before it is a row of its own.
    """
    spread, nodes_of = dealt(strings, ["check", "root", "block"], budget, limit, least)

    def lists(told: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(told), dtype=bool)
        new[1:] = (told[1:, :2] != told[:-1, :2]).any(axis=1)
        first = np.flatnonzero(new)
        nodes = pa.ListArray.from_arrays(pa.array(np.append(first, len(told)), type=pa.int32()), pa.array(told[:, 2]))
        return pa.RecordBatch.from_arrays([pa.array(told[first, 0]), pa.array(told[first, 1]), nodes], names=["own", "block", "nodes"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        column = {c: rows.column(c).to_numpy() for c in rows.column_names}
        told = np.zeros((0, 3), dtype=np.int64)
        for x, y in met_pairs(column, nodes_of.value[int(column["g"][0])], budget, check_budget):
            swap = column["node"][x] > column["node"][y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            fresh = np.stack([column["block"][x], column["block"][y], column["node"][x]], axis=1)
            told = np.unique(np.concatenate([told, fresh]), axis=0)
            if len(told) > GROUP_ROWS:
                yield lists(told)
                told = told[:0]
        if len(told):
            yield lists(told)

    told = spread.groupBy("g").applyInArrow(solve, "own long, block long, nodes array<long>")
    once = told.groupBy("own", "block").agg(F.array_distinct(F.flatten(F.collect_list("nodes"))).alias("nodes"))
    return once.select(F.explode("nodes").alias("node"), "block")

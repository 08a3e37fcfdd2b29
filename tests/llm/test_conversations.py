"""The conversation trie against brute force, with shards of every size, and on awkward inputs."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import conversations as cv
from termloom.llm.common import crc_share

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(spark, rows, schema=SCHEMA):
    model = F.col("conv_id") - F.col("conv_id") % 100
    return cv.rebuilt_conversations(cv.turn_lists(spark.createDataFrame(rows, schema)), model, crc_share("conv_id", 6))


def brute(rows):
    own: dict = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members: dict = {}
    for c, turns in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        model = c - int(np.fmod(c, 100))
        made = lists.get(model, [])[:h] + turns[h:]
        for d in range(len(made) + 1):
            members.setdefault(tuple(made[:d]), []).append((c, d == len(made)))
    out = set()
    for node, convs in members.items():
        under = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in under if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in under)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in under if n)
        ends = ",".join(str(c) for c in sorted(c for c, end in convs if end))
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        children = sum(len(n) == len(node) + 1 for n in under)
        out.add((min(c for c, _ in convs), len(node), parent, len(convs), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def many(seed, n=260):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(900, n, replace=False).tolist():
        hot = rng.random() < 0.35
        for turn in range(int(rng.integers(1, 9))):
            text = f"hot {turn}" if hot and turn < 4 else f"text {rng.integers(0, 3)}é"
            rows.append((c, turn, ["user", "assistant"][turn % 2], text))
    return rows


AWKWARD = [
    (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "a", "b"), (None, 0, "user", "no id"), (-7, 2, "user", "é🤖"), (-7, None, "x", None),
    (100, 0, "u", "base"), (101, 0, "u", "own"), (102, 0, "u", "base"), (205, 5, "u", "no model"), (300, 0, "a:b", "c"), (301, 0, "a", "b:c"),
    *[(400, i, "u", f"t{i % 3}" * 50) for i in range(2_000)],
]


@pytest.mark.parametrize("shard_turns", [200_000, 60, 1])
def test_nodes_equal_brute_force(spark, shard_turns):
    rows = many(1)
    got = cv.prefix_trie(rebuilt(spark, rows), shard_turns).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(rows)


@pytest.mark.parametrize("shard_turns", [200_000, 1])
def test_awkward_conversations(spark, shard_turns):
    rows = [(*r, "x", 1) for r in AWKWARD if r[0] != 400] + [(*r, "x", 1) for r in AWKWARD if r[0] == 400][:60]
    schema = f"{SCHEMA}, depth string, node int"
    got = cv.prefix_trie(rebuilt(spark, rows, schema), shard_turns).collect()
    assert set(map(tuple, got)) == brute(rows)
    whole = cv.prefix_trie(rebuilt(spark, AWKWARD), shard_turns)
    assert whole.agg(F.max("depth")).first()[0] >= 1_995


def test_no_conversations(spark):
    assert cv.prefix_trie(rebuilt(spark, [])).count() == 0
    assert cv.prefix_trie(rebuilt(spark, [(None, 1, "u", "t")])).count() == 0


def test_ranges_of_ids_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(cv, "ID_RANGE", 7)
    rows = [(c, 0, "u", "all the same") for c in [*range(-40, 90), 10**15, -(10**15)]]
    got = cv.prefix_trie(rebuilt(spark, rows)).collect()
    assert set(map(tuple, got)) == brute(rows)


def test_double_array_holds_exactly_its_sequences():
    rng = np.random.default_rng(5)
    sequences = sorted({tuple(rng.integers(1, 9, int(n)).tolist()) for n in rng.integers(0, 6, 300)})
    base, check = cv.DoubleArray(list(map(list, sequences))).arrays()
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    assert (check >= 0).sum() == len(prefixes)

    def walk(s):
        node = 0
        for turn in s:
            child = base[node] + turn
            if not 0 < child < len(check) or check[child] != node:
                return False
            node = child
        return True

    assert all(map(walk, prefixes))
    assert not any(walk((*p, c)) for p in prefixes for c in range(1, 10) if (*p, c) not in prefixes)

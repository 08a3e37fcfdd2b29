"""Order statistics and numbering against brute force, on both of their paths."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from termloom.operators import lookups, ranking


def legacy(values, p):
    values, n = sorted(values), len(values)
    pos = p * (n + 1) / 100
    if pos < 1:
        return values[0]
    if pos >= n:
        return values[-1]
    low = values[math.floor(pos) - 1]
    return low + (pos - math.floor(pos)) * (values[math.floor(pos)] - low)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(5)
    sizes = {"one": 1, "two": 2, "few": 7, "ties": 3000, "many": 4001}
    return {
        g: [float(rng.randrange(20)) if g == "ties" else rng.uniform(0, 1e6) for _ in range(n)]
        for g, n in sizes.items()
    }


@pytest.mark.parametrize("small_group", [ranking.SMALL_GROUP, 50])
@pytest.mark.parametrize("percent", [0.5, 25, 50, 99.5, 100])
def test_percentile_by_position(spark, groups, monkeypatch, small_group, percent):
    monkeypatch.setattr(ranking, "SMALL_GROUP", small_group)
    monkeypatch.setattr(ranking, "BRACKET", 0.01 if small_group == 50 else ranking.BRACKET)
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r["g"]: r["cut"] for r in ranking.percentile_legacy(df, "v", percent, ["g"]).collect()}
    assert got == {g: pytest.approx(legacy(vs, percent)) for g, vs in groups.items()}


def test_percentile_is_not_sparks(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 5)], "v double")
    assert ranking.percentile_legacy(df, "v", 25).first()["cut"] == 1.25


@pytest.mark.parametrize("percent", [0, -1, 100.5])
def test_percentile_rejects(spark, percent):
    with pytest.raises(ValueError):
        ranking.percentile_legacy(spark.createDataFrame([(1.0,)], "v double"), "v", percent)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9])
def test_upper_median(spark, n):
    df = spark.createDataFrame([(float(i),) for i in range(n)], "v double")
    assert ranking.upper_median(df, "v").first()["median"] == n // 2


def test_rank_by_hash_matches_one_sort(spark):
    keys = [(g, f"k{i}") for g in "ab" for i in range(500)]
    df = spark.createDataFrame(keys, "g string, k string")
    got = {(r["g"], r["k"]): r["rank"] for r in ranking.rank_by_hash(df, F.col("k"), ["g"], seed="s").collect()}
    order = sorted((k for g, k in keys if g == "a"), key=lambda k: hashlib.md5(("s" + k).encode()).hexdigest())
    assert got == {(g, k): i + 1 for g in "ab" for i, k in enumerate(order)}


@pytest.mark.parametrize("limit", [ranking.SMALL_GROUP, 10])
def test_number_by_hash_same_on_both_paths(spark, monkeypatch, limit):
    monkeypatch.setattr(ranking, "SMALL_GROUP", limit)
    df = spark.createDataFrame([(f"w{i}",) for i in range(200)], "term string")
    got = {r["term"]: r["idx"] for r in ranking.number_by_hash(df, "term").collect()}
    order = sorted(got, key=lambda k: hashlib.md5(k.encode()).hexdigest())
    assert [got[k] for k in order] == list(range(1, 201))


def test_dense_rank_of_index_over_buckets(spark):
    indices = [5, 70_000, 70_001, 200_000, 65_535, 65_536, 1]
    df = spark.createDataFrame([(i,) for i in indices], "idx int")
    got = {r["idx"]: r["new_idx"] for r in ranking.dense_rank_of_index(df, "idx").collect()}
    assert got == {i: n + 1 for n, i in enumerate(sorted(indices))}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast(spark, monkeypatch, how):
    """A key with a third of all rows, joined both ways."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(900)]
    big = spark.createDataFrame(rows, "k string, i int")
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3)], "k string, s int")
    plain = sorted(map(tuple, lookups.lookup_join(big, table, ["k"], how).collect()), key=str)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    joined = lookups.lookup_join(big, table, ["k"], how)
    assert "_salt" in joined._jdf.queryExecution().toString()
    assert sorted(map(tuple, joined.collect()), key=str) == plain


def test_first_in_hash_order_is_exact(spark, monkeypatch):
    monkeypatch.setattr(ranking, "HEAD_DIGITS", 1)
    df = spark.range(500).select(F.col("id").alias("k")).union(spark.createDataFrame([(None,)], "k long")).repartition(7)
    order = sorted(range(500), key=lambda k: hashlib.md5(f"s{k}".encode()).hexdigest())
    for n in (0, 1, 40, 499, 10_000):
        got = [r["k"] for r in ranking.bottom_by_hash(df, F.col("k"), n, "s").collect()]
        assert sorted(got) == sorted(order[:n])


def test_large_lookup_is_not_broadcast_and_its_copies_are_bounded(spark, monkeypatch):
    """Spark would broadcast all copies on the size of a file that holds one; a side of many rows has no copies."""
    big = spark.range(2000).selectExpr("cast(id % 700 as string) AS k", "id AS i")
    table = spark.range(600).selectExpr("cast(id as string) AS k", "id AS s")
    plain = sorted(map(tuple, lookups.lookup_join(big, table, ["k"]).collect()))
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    for bound in (2_000_000, 1200, 1):
        monkeypatch.setattr(lookups, "REPEATED_ROWS", bound)
        assert lookups.salts_for(600) * 600 <= max(bound, 600)
        joined = lookups.lookup_join(big, table, ["k"])
        plan = joined._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan and ("_salt" in plan) == (bound > 600)
        assert sorted(map(tuple, joined.collect())) == plain


def test_duplicate_share_repeats_no_hashes(spark, monkeypatch):
    from termloom.sources.store import duplicate_share

    stored = spark.createDataFrame([("hot",)] * 40 + [("a",), ("b",)], "row_hash string")
    incoming = spark.createDataFrame([("hot",)] * 5 + [("b",), ("c",), ("c",)], "row_hash string")
    plain = duplicate_share(incoming, stored).collect()
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    shared = duplicate_share(incoming, stored)
    assert "_salt" not in shared._jdf.queryExecution().toString()
    assert shared.collect() == plain and plain[0]["n_known"] == 6

"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors go to the nearest of a fixed number of pivots. From summaries of the
cells (radius, the k+1 nearest distances) the driver derives, for each cell of
queries, a score that its k-th best hit cannot fall below, and from it the
distance from which on a vector of another cell can still matter. Only such
vectors are sent to a group of queries, in blocks of bounded size; each block
is solved by one matrix product, and the blocks' best are merged per query.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import map_batches
from termloom.scratch import publish

PIVOTS = 32
#: Queries that form a group, and vectors that form a block, at most (about).
GROUP_QUERIES = 8_192
BLOCK_ROWS = 32_768
#: Blocks at least, so that small inputs keep several tasks busy.
LEAST_BLOCKS = 8
#: Queries scored at once in a task.
TILE = 128
#: Relative room for rounding in the bounds; results are exact integers.
SLACK = 1e-9


def scaled_vectors(vectors: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<long>): floor(scale * x); rows with a null id or a null or non-finite component take no part.

    Of rows with the same id the smallest vector counts.
    """
    x = F.col(vec_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(
        "id IS NOT NULL AND x IS NOT NULL AND forall(x, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity'))"
    )
    whole = F.transform("x", lambda v: F.floor(F.lit(scale) * v))
    return usable.select("id", whole.alias("vec")).groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(rows: list, dims: int) -> np.ndarray:
    """Rows of whole numbers, short ones padded with zeros."""
    out = np.zeros((len(rows), dims), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def cell_thresholds(pivots: np.ndarray, query_radius: np.ndarray, near: list[list[float]], far: np.ndarray, k: int) -> np.ndarray:
    """``[i, j]``: the least distance from pivot j at which a vector can be among the k best of a query of cell i; inf: none can."""
    m = len(pivots)
    norms, inner = np.linalg.norm(pivots, axis=1), pivots @ pivots.T
    least = np.full((m, m), np.inf)
    for i in range(m):
        if query_radius[i] < 0:
            continue
        reach = norms[i] + query_radius[i]
        floors = [inner[i, j] - query_radius[i] * norms[j] - reach * d for j in range(m) for d in near[j]]
        # one of them may be the query itself
        theta = sorted(floors, reverse=True)[k] if len(floors) > k else -np.inf
        for j in range(m):
            if far[j] < 0:
                continue
            gap = theta - inner[i, j] - query_radius[i] * norms[j]
            room = SLACK * (abs(theta) + abs(inner[i, j]) + norms[i] * norms[j] + 1) if np.isfinite(theta) else 0
            need = -np.inf if not np.isfinite(theta) else (gap - room) / reach if reach > 0 else (-np.inf if gap <= room else np.inf)
            if need <= far[j] * (1 + SLACK) + SLACK:
                least[i, j] = need - SLACK * (1 + abs(far[j])) if np.isfinite(need) else need
    return least


def top_inner(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    pivots: int = PIVOTS,
    group_queries: int = GROUP_QUERIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``. A row with the query's own
    id is no candidate. Vectors of different length meet as if padded with
    zeros; scores must fit a long. Fewer candidates give fewer rows; no query or
    no vector gives an empty result.
    """
    spark = vectors.sparkSession
    base = publish(scaled_vectors(vectors, scale, id_col, vec_col).withColumn("query", is_query), "vectors")
    size = base.agg(
        F.count("*").alias("n"), F.max(F.size("vec")).alias("dims"), F.count_if("query").alias("queries"),
        F.max(F.array_max(F.transform("vec", F.abs))).alias("largest"),
    ).first()
    dims, largest = max(size["dims"] or 1, 1), float(size["largest"] or 0)
    chosen = base.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()  # a fixed number
    centres = matrix([r["vec"] for r in chosen], dims).astype(np.float64) if chosen else np.zeros((1, dims))
    m = len(centres)
    exact = largest * largest * dims < 2.0**53
    packed = np.dtype(np.int16 if largest < 2**15 else np.int64)

    def assign():
        norms = (centres * centres).sum(axis=1)

        def work(rows: dict) -> dict:
            v = matrix(rows["vec"], dims)
            x = v.astype(np.float64)
            apart = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + norms, 0)
            cell = apart.argmin(axis=1)
            # the distance itself without cancellation
            dist = np.linalg.norm(x - centres[cell], axis=1)
            return {"id": rows["id"], "query": rows["query"], "cell": cell, "dist": dist, "vec": [r.tobytes() for r in v.astype(packed)]}

        return work

    cells = publish(map_batches(base, "id long, query boolean, cell int, dist double, vec binary", assign), "cells")

    def summarise(batches):
        import pyarrow as pa

        near: dict[int, np.ndarray] = {}
        stats = np.full((m, 2), -1.0)  # radius of the vectors, of the queries
        for batch in batches:
            cell, dist = batch.column("cell").to_numpy(), batch.column("dist").to_numpy()
            asks = batch.column("query").to_numpy(zero_copy_only=False)
            for c in np.unique(cell).tolist():
                own = dist[cell == c]
                near[c] = np.sort(np.concatenate([near.get(c, own[:0]), own]))[: k + 1]
                stats[c, 0] = max(stats[c, 0], own.max())
                stats[c, 1] = max(stats[c, 1], dist[(cell == c) & asks].max(initial=-1.0))
        kept = sorted(near)
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(kept, pa.int32()), "far": [stats[c, 0] for c in kept], "radius": [stats[c, 1] for c in kept],
             "near": pa.array([near[c].tolist() for c in kept], pa.list_(pa.float64()))},
            schema=pa.schema([("cell", pa.int32()), ("far", pa.float64()), ("radius", pa.float64()), ("near", pa.list_(pa.float64()))]),
        )

    parts = cells.select("cell", "dist", "query").mapInArrow(summarise, "cell int, far double, radius double, near array<double>")
    summary = parts.groupBy("cell").agg(
        F.max("far").alias("far"), F.max("radius").alias("radius"),
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"),
    ).collect()  # one row per pivot
    counts = {r["cell"]: r["count"] for r in cells.filter("query").groupBy("cell").count().collect()}
    far, radius, near = np.full(m, -1.0), np.full(m, -1.0), [[] for _ in range(m)]
    for r in summary:
        far[r["cell"]], radius[r["cell"]], near[r["cell"]] = r["far"], r["radius"], r["near"]
    least = cell_thresholds(centres, radius, near, far, k)

    # cells of queries are gathered into groups; a cell with very many is cut by id
    groups: list[tuple[int, int, int]] = []  # cell, cut, cuts
    for c in sorted(counts):
        cut = -(-counts[c] // group_queries)
        groups += [(c, i, cut) for i in range(cut)]
    number, filled, group_of = 0, 0, {}
    for c, i, cut in groups:
        share = counts[c] / cut
        if filled and filled + share > group_queries:
            number, filled = number + 1, 0
        group_of[c, i] = number
        filled += share
    n_groups = number + 1
    cuts = {c: cut for c, _, cut in groups}
    need = np.full((n_groups, m), np.inf)  # [group, cell of the vector]
    for (c, _), g in group_of.items():
        need[g] = np.minimum(need[g], least[c])
    blocks = max(LEAST_BLOCKS, -(-(size["n"] or 0) // block_rows))

    def deal():
        def work(rows: dict) -> dict:
            cell, dist = np.array(rows["cell"]), np.array(rows["dist"])
            ids = np.array(rows["id"], dtype=np.int64)
            block = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % blocks
            g, i = np.nonzero(dist[None, :] >= need[:, cell])
            out = [(int(a), int(block[b]), False, int(b)) for a, b in zip(g, i, strict=True)]
            for at in np.flatnonzero(rows["query"]).tolist():
                c = int(cell[at])
                own = group_of[c, int(ids[at]) % cuts[c]]
                out += [(own, b, True, at) for b in range(blocks)]
            return {
                "g": [x[0] for x in out], "block": [x[1] for x in out], "query": [x[2] for x in out],
                "id": [int(ids[x[3]]) for x in out], "cell": [int(cell[x[3]]) for x in out], "dist": [float(dist[x[3]]) for x in out],
                "vec": [rows["vec"][x[3]] for x in out],
            }

        return work

    dealt = map_batches(cells, "g int, block int, query boolean, id long, cell int, dist double, vec binary", deal)

    def solve(pdf):
        import pandas as pd

        asks = pdf[pdf["query"]].sort_values("id")
        data = pdf[~pdf["query"]].sort_values("id")
        if asks.empty or data.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

        def unpack(part):
            return np.frombuffer(b"".join(part["vec"]), dtype=packed).reshape(len(part), dims).astype(np.float64 if exact else np.int64)

        ids, cell, dist, found = data["id"].to_numpy(), data["cell"].to_numpy(), data["dist"].to_numpy(), []
        own_cell, own_ids = asks["cell"].to_numpy(), asks["id"].to_numpy()
        everything, queries = unpack(data), unpack(asks)
        for c in np.unique(own_cell).tolist():
            wanted = np.flatnonzero(dist >= least[c][cell])
            if not len(wanted):
                continue
            sub, sub_ids, mine = everything[wanted], ids[wanted], np.flatnonzero(own_cell == c)
            for at in range(0, len(mine), TILE):
                tile = mine[at : at + TILE]
                scores = queries[tile] @ sub.T
                for q, s in zip(own_ids[tile].tolist(), scores, strict=True):
                    rest = np.flatnonzero(sub_ids != q)
                    if len(rest) > k:
                        rest = rest[s[rest] >= np.partition(s[rest], len(rest) - k)[len(rest) - k]]
                    best = rest[np.lexsort((sub_ids[rest], -s[rest]))][:k]
                    found.append((np.full(len(best), q), sub_ids[best], s[best].astype(np.int64)))
        return pd.DataFrame({n: np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i, n in enumerate(("query_id", "vec_id", "score"))})

    best = dealt.groupBy("g", "block").applyInPandas(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

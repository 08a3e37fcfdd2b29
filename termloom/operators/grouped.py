"""k-means of many groups at once: labels, or clusters of a first tier.

Centres are a table (target, cluster, term, value) and each step is one plan for
all groups, so the number of jobs depends on the rounds and not on how many
groups there are; a group with a third of all rows is spread like any other. A
group leaves when its centres stand still.

Where all centres together are a small matrix, rows are packed once, with terms
as numbers, and a step is one pass over them that shuffles only sums. Larger
centres stay a table, and cells meet them in joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.lookups import lookup_join
from termloom.operators.ranking import top_per_group
from termloom.scratch import gathering_by_hash, publish, write_table

CENTRES_SCHEMA = "target string, cluster int, term string, value double"
REPORT_SCHEMA = "target string, iteration int, cluster string, rank int, term string, value double"
#: A centre that moved less stands still.
STILL = 1e-4
#: A row this near to a centre, by its own size, is the same as the centre.
SAME = 1e-12
#: Cells that a task gathers into rows, about.
VECTOR_CELLS = 1 << 19
#: Numbers of all centres together, of every group, up to which they go to the tasks as one matrix.
MATRIX = 1 << 19


def nearest(cells: DataFrame, centres: DataFrame, k: int) -> DataFrame:
    """(target, row_id, cluster, apart, size, cells) of each row: its nearest centre, the smaller number of equally near ones.

    ``apart`` is the squared distance and ``size`` the row's squared length.
    Groups without centres are left out. Cells meet the centres of their group
    and term, k columns wide, and are summed per row: one shuffle.
    """
    numbers = list(range(k))

    def wide(keys: list[str], value, mark: str) -> DataFrame:
        table = centres.groupBy(*keys).pivot("cluster", numbers).agg(F.sum(value))
        return table.select(*keys, *[F.col(str(j)).alias(f"{mark}{j}") for j in numbers])

    places = wide(["target", "term"], F.col("value"), "_c")
    norms = wide(["target"], F.col("value") * F.col("value"), "_n")
    joined = lookup_join(cells.select("target", "row_id", "term", "value"), places, ["target", "term"], "left")
    dots = [F.sum(F.col("value") * F.coalesce(F.col(f"_c{j}"), F.lit(0.0))).alias(f"_d{j}") for j in numbers]
    rows = joined.groupBy("target", "row_id").agg(
        F.sum(F.col("value") * F.col("value")).alias("size"), F.collect_list(F.struct("term", "value")).alias("cells"), *dots
    )
    apart = [
        F.when(F.col(f"_n{j}").isNotNull(), F.struct((F.col("size") - 2 * F.col(f"_d{j}") + F.col(f"_n{j}")).alias("d"), F.lit(j).alias("j")))
        for j in numbers
    ]
    best = F.array_min(F.array_compact(F.array(*apart)))
    found = lookup_join(rows, norms, ["target"]).withColumn("_b", best)
    return found.select("target", "row_id", F.col("_b.j").alias("cluster"), F.col("_b.d").alias("apart"), "size", "cells")


def spread_starts(cells: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """Up to k rows of each group as first centres, drawn one after the other by squared distance to those drawn before.

    A row's draw is its hash, so reruns agree; a group with fewer distinct rows gets fewer centres.
    """

    def drawn(rows: DataFrame, j: int) -> DataFrame:
        share = (F.pmod(F.xxhash64("row_id", F.lit(seed), F.lit(j)), F.lit(1 << 40)) + 0.5) / F.lit(float(1 << 40))
        picked = rows.groupBy("target").agg(F.min_by("cells", F.struct(-F.log(share) / F.col("apart"), "row_id")).alias("cells"))
        return publish(picked.select("target", F.lit(j).alias("cluster"), F.inline("cells")), "starts")

    whole = cells.groupBy("target", "row_id").agg(F.collect_list(F.struct("term", "value")).alias("cells"))
    centres = drawn(whole.withColumn("apart", F.lit(1.0)), 0)
    for j in range(1, k):
        further = nearest(cells, centres, k).where(F.col("apart") > SAME * F.col("size"))
        more = drawn(further, j)
        if more.isEmpty():
            break
        centres = centres.unionByName(more)
    return centres


@dataclass(frozen=True)
class Packed:
    """Rows (target, row_id, g, codes, values) and what the numbers say: of each code its group and term, of each g its label."""

    rows: DataFrame
    groups: list[str | None]
    group: np.ndarray
    terms: list[str]

    def coded(self, table: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Centres (target, cluster, term, value) as a matrix (code, cluster), and which of the clusters there are (g, cluster)."""
        code = {(self.groups[g], t): i for i, (g, t) in enumerate(zip(self.group.tolist(), self.terms, strict=True))}
        matrix, there = np.zeros((len(self.terms), k)), np.zeros((len(self.groups), k), dtype=bool)
        for r in table.select("target", "cluster", "term", "value").collect():
            i = code.get((r["target"], r["term"]))
            if i is not None:
                matrix[i, r["cluster"]] += r["value"]
                there[self.group[i], r["cluster"]] = True
        return matrix, there

    def table(self, matrix: np.ndarray) -> DataFrame:
        """The matrix as centres (target, cluster, term, value)."""
        code, cluster = np.nonzero(matrix)
        columns = {
            "target": pa.array([self.groups[g] for g in self.group[code].tolist()], pa.string()),
            "cluster": pa.array(cluster, pa.int32()),
            "term": pa.array([self.terms[i] for i in code.tolist()], pa.string()),
            "value": pa.array(matrix[code, cluster], pa.float64()),
        }
        return publish(self.rows.sparkSession.createDataFrame(pa.table(columns)), "centres")


def packed(cells: DataFrame, k: int) -> Packed | None:
    """Rows gathered once; nothing where k centres of every group would not be a small matrix."""
    pairs = write_table(cells.select("target", "term").distinct(), "pairs")
    if pairs.rows * k > MATRIX:
        return None
    found = sorted((r["target"] is not None, r["target"] or "", r["term"]) for r in pairs.table.collect() if r["term"] is not None)
    labels = list(dict.fromkeys(f[:2] for f in found))
    place = {x: g for g, x in enumerate(labels)}
    group, terms = np.array([place[f[:2]] for f in found], dtype=np.int64), [f[2] for f in found]
    groups = [label if named else None for named, label in labels]
    spark = cells.sparkSession
    codes = pa.table({
        "_target": pa.array([groups[g] for g in group.tolist()], pa.string()), "_term": pa.array(terms, pa.string()),
        "g": pa.array(group, pa.int32()), "code": pa.array(range(len(terms)), pa.int32()),
    })
    met = cells.join(F.broadcast(publish(spark.createDataFrame(codes), "codes")), F.col("target").eqNullSafe(F.col("_target")) & (F.col("term") == F.col("_term")))
    parts = max(spark.sparkContext.defaultParallelism, -(-cells.count() // VECTOR_CELLS))
    dealt = met.select("target", "row_id", "g", "code", "value").repartition(parts, "target", "row_id")
    rows = dealt.groupBy("target", "row_id", "g").agg(F.sort_array(F.collect_list(F.struct("code", "value"))).alias("_c"))
    with gathering_by_hash(spark, VECTOR_CELLS):
        return Packed(publish(rows.select("target", "row_id", "g", F.col("_c.code").alias("codes"), F.col("_c.value").alias("values")), "packed"), groups, group, terms)


def distances(batch: pa.RecordBatch, matrix: np.ndarray, there: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of packed rows: the g, the nearest cluster (the smaller number of equally near ones), its squared distance and the squared length; the codes, values and row of each cell."""
    g = batch.column("g").to_numpy()
    lists = batch.column("codes")
    codes, values = lists.flatten().to_numpy(), batch.column("values").flatten().to_numpy()
    n = lists.value_lengths().to_numpy()
    starts = np.cumsum(n) - n
    size = np.add.reduceat(values * values, starts)
    apart = np.stack([size - 2 * np.add.reduceat(values * matrix[codes, j], starts) + norms[g, j] for j in range(matrix.shape[1])], axis=1)
    apart[~there[g]] = np.inf
    cluster = np.argmin(apart, axis=1)
    return g, cluster, apart[np.arange(len(g)), cluster], size, codes, values, np.repeat(np.arange(len(g)), n)


def norms_of(at: Packed, matrix: np.ndarray) -> np.ndarray:
    out = np.zeros((len(at.groups), matrix.shape[1]))
    np.add.at(out, at.group, matrix * matrix)
    return out


def drawn_starts(at: Packed, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``spread_starts`` of packed rows, as a matrix and which clusters there are."""
    matrix, there = np.zeros((len(at.terms), k)), np.zeros((len(at.groups), k), dtype=bool)
    for j in range(k):
        share = (F.pmod(F.xxhash64("row_id", F.lit(seed), F.lit(j)), F.lit(1 << 40)) + 0.5) / F.lit(float(1 << 40))
        rows = at.rows.select("row_id", "g", "codes", "values", (-F.log(share)).alias("late"))
        # a row without a label is never near a centre
        rows = rows if j == 0 else rows.where(F.col("target").isNotNull())
        norms = norms_of(at, matrix)

        def first(batches: Iterator[pa.RecordBatch], j=j, matrix=matrix, there=there, norms=norms) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                g, _, apart, size, *_ = distances(batch, matrix, there, norms)
                far = np.ones(len(g)) if j == 0 else apart
                with np.errstate(divide="ignore", invalid="ignore"):
                    late = batch.column("late").to_numpy() / far
                open_ = np.flatnonzero((far > SAME * size) & np.isfinite(far)) if j else np.arange(len(g))
                least = np.full(int(g.max()) + 1, np.inf)
                np.minimum.at(least, g[open_], late[open_])
                picks = pa.array(open_[late[open_] <= least[g[open_]]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(picks) for c in ("row_id", "g", "codes", "values")] + [pa.array(late).take(picks)],
                    names=["row_id", "g", "codes", "values", "late"],
                )

        chosen = rows.mapInArrow(first, "row_id string, g int, codes array<int>, values array<double>, late double")
        taken = chosen.groupBy("g").agg(F.min_by(F.struct("codes", "values"), F.struct("late", "row_id")).alias("r")).collect()
        if not taken:
            break
        matrix, there = matrix.copy(), there.copy()
        for row in taken:
            np.add.at(matrix[:, j], row["r"]["codes"], row["r"]["values"])
            there[row["g"], j] = True
    return matrix, there


def matrix_kmeans(at: Packed, k: int, iterations: int, seed: int, starts: DataFrame | None) -> DataFrame:
    matrix, there = drawn_starts(at, k, seed) if starts is None else at.coded(starts, k)
    active = np.array([label is not None for label in at.groups], dtype=bool)
    for _ in range(iterations):
        norms = norms_of(at, matrix)
        still_open = np.flatnonzero(active & there.any(axis=1)).tolist()

        def sums(batches: Iterator[pa.RecordBatch], matrix=matrix, there=there, norms=norms) -> Iterator[pa.RecordBatch]:
            added, counts = np.zeros(matrix.size), np.zeros(there.size)
            for batch in batches:
                if batch.num_rows:
                    g, cluster, _, _, codes, values, row = distances(batch, matrix, there, norms)
                    added += np.bincount(codes.astype(np.int64) * matrix.shape[1] + cluster[row], weights=values, minlength=matrix.size)
                    counts += np.bincount(g.astype(np.int64) * there.shape[1] + cluster, minlength=there.size)
            for counting, found in ((False, added), (True, counts)):
                used = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array([counting] * len(used), pa.bool_()), pa.array(used), pa.array(found[used])], names=["counting", "at", "value"])

        rows = at.rows.select("g", "codes", "values").where(F.col("g").isin(still_open))
        found = rows.mapInArrow(sums, "counting boolean, at long, value double").groupBy("counting", "at").agg(F.sum("value").alias("value")).collect()
        added, counts = np.zeros(matrix.size), np.zeros(there.size)
        for r in found:
            (counts if r["counting"] else added)[r["at"]] = r["value"]
        added, counts = added.reshape(matrix.shape), counts.reshape(there.shape)
        used = counts[at.group] > 0
        moved = np.where(used, added / np.where(used, counts[at.group], 1), matrix)
        change = np.zeros(there.shape)
        np.add.at(change, at.group, (moved - matrix) ** 2)
        matrix, active = moved, active & (change > STILL * STILL).any(axis=1)
        if not active.any():
            break
    return at.table(matrix)


def grouped_kmeans(cells: DataFrame, k: int, iterations: int = 50, seed: int = 1, starts: DataFrame | None = None) -> DataFrame:
    """Centres (target, cluster, term, value) of every group of the written cells (target, row_id, term, value).

    A cluster that loses all its rows keeps its centre. An empty table gives no centres.
    """
    at = packed(cells, k)
    return joined_kmeans(cells, k, iterations, seed, starts) if at is None else matrix_kmeans(at, k, iterations, seed, starts)


def joined_kmeans(cells: DataFrame, k: int, iterations: int, seed: int, starts: DataFrame | None) -> DataFrame:
    """The same with centres as a table."""
    centres = publish(spread_starts(cells, k, seed) if starts is None else starts, "centres")
    done: list[DataFrame] = []
    active = cells
    for _ in range(iterations):
        # the entry without a term counts the rows
        one = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1.0).alias("value")))
        opened = nearest(active, centres, k).select("target", "cluster", F.inline(F.concat("cells", one)))
        sums = publish(opened.groupBy("target", "cluster", "term").agg(F.sum("value").alias("value")), "sums")
        sizes = write_table(sums.where("term IS NULL").select("target", "cluster", F.col("value").alias("_n")), "sizes")
        means = lookup_join(sums.where("term IS NOT NULL"), sizes, ["target", "cluster"])
        means = means.select("target", "cluster", "term", (F.col("value") / F.col("_n")).alias("value"))
        unused = lookup_join(centres, sizes, ["target", "cluster"], "left_anti").select("target", "cluster", "term", "value")
        moved = publish(means.unionByName(unused), "centres")
        signed = moved.unionByName(centres.withColumn("value", -F.col("value")).select(moved.columns))
        change = signed.groupBy("target", "cluster", "term").agg(F.sum("value").alias("_d"))
        change = change.groupBy("target", "cluster").agg(F.sum(F.col("_d") * F.col("_d")).alias("_d"))
        moving = write_table(change.where(F.col("_d") > STILL * STILL).select("target").distinct(), "moving")
        done.append(lookup_join(moved, moving, ["target"], "left_anti").select(moved.columns))
        centres = lookup_join(moved, moving, ["target"], "left_semi").select(moved.columns)
        if not moving.rows:
            return _all(done)
        active = lookup_join(cells, moving, ["target"], "left_semi")
    return _all([*done, centres])


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def grouped_trim_cycle(
    cells: DataFrame, k: int, iterations: int, top_terms: int, spread: int, max_rounds: int | None = None
) -> DataFrame:
    """Per group: cluster, report the top terms, remove those spread over too many clusters, and cluster again.

    All groups go through a round together; one without wide terms leaves, and
    each round but a group's last removes at least one of its terms, so the
    cycle ends by itself. Report: target, iteration, cluster, rank, term, value.
    """
    current = publish(cells.select("target", "row_id", "term", "value"), "cells")
    reports: list[DataFrame] = []
    for iteration in count():
        if iteration == max_rounds:
            break
        centres = grouped_kmeans(current, k, iterations)
        top = top_per_group(centres.where("value <> 0"), ["target", "cluster"], [F.col("value").desc(), F.col("term")], top_terms)
        report = write_table(
            top.select(
                "target", F.lit(iteration).alias("iteration"), F.col("cluster").cast("string").alias("cluster"),
                F.col("rank").cast("int").alias("rank"), "term", "value",
            ),
            "report",
        )
        if not report.rows:
            break
        reports.append(report.table)
        wide = report.table.groupBy("target", "term").agg((F.count("*") - 1).alias("spread")).where(F.col("spread") > spread)
        wide = write_table(wide.select("target", "term"), "wide")
        if not wide.rows:
            break
        again = lookup_join(current, wide.table.select("target"), ["target"], "left_semi")
        left = lookup_join(again, wide, ["target", "term"], "left_anti")
        current = publish(left.select("target", "row_id", "term", "value"), "cells")
    return _all(reports) if reports else cells.sparkSession.createDataFrame([], REPORT_SCHEMA)

"""Connected components of a link table, by hooking, jumping and contraction.

Every round works on tables: each node is hooked onto its smallest neighbour, the
trees that this makes are flattened by jumps between nodes, and links are told
between the roots of their ends; those within one tree are done. So a link is
joined again only while it holds trees apart that are not yet one, and a group of
near copies, whose links mostly end in one node, is done in the first round. A node
with very many links only ever meets joins that Spark may split and sums that are
pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.scratch import publish


def flattened(labels: DataFrame) -> DataFrame:
    """(node, root) where every root is its own: labels jump to their label's label until none moves."""
    while True:
        tops = labels.select("root").distinct()
        moves = tops.join(labels.filter("node <> root").select(F.col("node").alias("root"), F.col("root").alias("further")), "root")
        moves = publish(moves, "moves")
        if moves.isEmpty():
            return labels
        labels = publish(moved(labels, moves), "labels")


def moved(labels: DataFrame, moves: DataFrame) -> DataFrame:
    """Labels (node, root), the roots that are listed in ``moves`` (root, further) replaced."""
    return labels.join(moves, "root", "left").select("node", F.coalesce("further", "root").alias("root"))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node of its component.

    Links between a node and itself, and links with a null, say nothing.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    left = publish(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        ends = left.select(F.col("a").alias("node"), F.col("a").alias("low")).union(left.select("b", "a"))
        trees = flattened(publish(ends.groupBy("node").agg(F.min("low").alias("root")), "labels"))
        further = trees.filter("node <> root").select(F.col("node").alias("root"), F.col("root").alias("further"))
        state = trees if state is None else publish(moved(state, further), "labels")
        above = left.join(trees.select(F.col("node").alias("b"), F.col("root").alias("high")), "b").filter("high <> a")
        apart = above.join(trees.select(F.col("node").alias("a"), F.col("root").alias("low")), "a").filter("high <> low")
        left = publish(apart.select(F.least("low", "high").alias("a"), F.greatest("low", "high").alias("b")).distinct(), "links")
        if left.isEmpty():
            return state

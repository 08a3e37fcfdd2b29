"""Mixing sources to target weights by Pareto order sampling.

Every document of a source is due ``target / source size`` copies. The whole
part of that is certain; for the rest, documents are ranked by random odds
divided by inclusion odds and taken in that order up to the words still due.
The cut of each source is found over counted key ranges, two levels of 4096 and
then the few documents between, so no source is ever sorted in one task; the
cuts then meet the documents in one pass, without a shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.lookups import lookup_join
from termloom.scratch import publish

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the range key: two levels of 12, and 12 more for the order inside.
KEY_BITS, LEVEL_BITS = 36, 12
#: md5 digits that make a uniform number; 52 bits are exact in a double.
UNIFORM_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) from the md5 of the columns' texts, the same on every run."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, UNIFORM_DIGITS), 16, 10).cast("long")
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(2 ** (4 * UNIFORM_DIGITS)))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``sizes`` (src, no_src, source_size) with ``target``; one row per source.

    Sources in code-point order, null last, take the weights in turn. A target
    that would pass ``most`` times the source's size stops there, and the rest
    is shared by weight: sources are capped in the order of room per weight for
    as long as the common share per weight would pass it.
    """
    in_order = Window.orderBy("no_src", "src")
    turn = F.element_at(F.lit(list(weights)), (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1).cast("int"))
    room = sizes.withColumn("weight", turn.cast("double")).withColumn("room", F.col("source_size") * F.lit(float(most)))
    before = Window.orderBy(F.col("room") / F.col("weight"), "no_src", "src").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    due = F.sum("source_size").over(everything).cast("double") * F.lit(float(share))
    left = due - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = room.withColumn("level", left / weight_left).withColumn("capped", F.col("room") / F.col("weight") <= F.col("level"))
    # the levels fall after the first source that is not capped; that one's is the share of all of them
    common = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return level.select(
        "src", "no_src", "source_size", F.when(F.col("capped"), F.col("room")).otherwise(common * F.col("weight")).alias("target")
    )


def order_key(rank: Column) -> Column:
    """Order-preserving range key of a rank in (0, infinity)."""
    return F.floor(rank / (rank + F.lit(1.0)) * F.lit(float(2**KEY_BITS))).cast("long")


def cuts(ranked: DataFrame, per_source: DataFrame) -> DataFrame:
    """(src, no_src, cut): the rank up to which a source's documents come nearest to the words due.

    ``ranked``: (src, no_src, key, rank, size); ``per_source``: (src, no_src,
    due). Documents of equal rank are taken together; of two equally near cuts
    the smaller counts; a source without a cut takes none.
    """
    keys = ["src", "no_src"]
    state = per_source.filter("due > 0").select(*keys, "due", F.lit(0).cast("long").alias("taken"))
    part = ranked
    for level in (1, 2):
        shift = KEY_BITS - level * LEVEL_BITS
        part = lookup_join(part.drop("due", "taken"), publish(state, "due"), keys).withColumn("bin", F.shiftright("key", shift))
        if level == 2:
            part = part.filter(F.shiftright("bin", LEVEL_BITS) == F.col("bin0"))
        bins = part.groupBy(*keys, "bin").agg(F.sum("size").alias("words"), F.first("due").alias("due"), F.first("taken").alias("taken"))
        run = F.col("taken") + F.sum("words").over(Window.partitionBy(*keys).orderBy("bin"))
        reached = bins.withColumn("run", run).withColumn("start", F.col("run") - F.col("words"))
        # the bin in which the words due are reached; the last one if they never are
        last = F.max("bin").over(Window.partitionBy(*keys)) == F.col("bin")
        here = reached.withColumn("last", last).filter((F.col("start") < F.col("due")) & ((F.col("run") >= F.col("due")) | F.col("last")))
        state = here.select(*keys, "due", F.col("start").alias("taken"), F.col("bin").alias("bin0"))
        part = part.drop("bin", "bin0")
    inner = lookup_join(part.drop("due", "taken"), publish(state, "due"), keys).filter(
        F.shiftright("key", KEY_BITS - 2 * LEVEL_BITS) == F.col("bin0")
    )
    ranks = inner.groupBy(*keys, "rank").agg(F.sum("size").alias("words"), F.first("due").alias("due"), F.first("taken").alias("taken"))
    run = F.col("taken") + F.sum("words").over(Window.partitionBy(*keys).orderBy("rank"))
    ends = ranks.withColumn("run", run).select(*keys, "due", "rank", "run")
    # the cut just before the first of these documents is a choice, too
    before = ranks.groupBy(*keys).agg(F.first("due").alias("due"), F.min("rank").alias("rank"), F.first("taken").alias("run")).select(
        *keys, "due", (F.col("rank") * F.lit(1 - 2.0**-50)).alias("rank"), "run"
    )
    choice = F.struct(F.abs(F.col("run") - F.col("due")), F.col("run"), F.col("rank"))
    return ends.unionByName(before).groupBy(*keys).agg(F.min(choice).alias("best")).select(*keys, F.col("best.rank").alias("cut"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words, repeats counted).

    A null source is a source of its own, a null text has size 0, and a text
    without words takes nothing. The random number of a row comes from its id
    and text, so reruns agree and identical rows are taken together. Columns of
    ``docs`` that are named like the new ones are replaced; an empty table
    gives an empty result.
    """
    made = ["size", "source_size", "target", "taken"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in made]).alias("row")
    source, text = F.col(f"`{source_col}`"), F.col(f"`{text_col}`")
    keyed = docs.select(
        row,
        F.coalesce(source.cast("string"), F.lit("")).alias("src"),
        source.isNull().alias("no_src"),
        word_count(text).alias("size"),
        uniform(F.col(f"`{id_col}`"), text).alias("u"),
    )
    thin = publish(keyed.drop("row"), "sizes")
    sizes = thin.groupBy("src", "no_src").agg(F.sum("size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = source_targets(sizes, weights, share, most).withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.floor(ratio))
    targets = publish(targets.withColumn("due", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    rank = (F.col("u") / (1 - F.col("u"))) / (F.col("part") / (1 - F.col("part")))
    open_sources = targets.filter("part > 0")
    ranked = lookup_join(thin.filter("size > 0"), open_sources.select("src", "no_src", "part"), ["src", "no_src"])
    ranked = publish(ranked.select("src", "no_src", order_key(rank).alias("key"), rank.alias("rank"), "size"), "ranked")
    cut = cuts(ranked, open_sources.select("src", "no_src", "due"))
    plan = targets.join(cut, ["src", "no_src"], "left").select("src", "no_src", "source_size", "target", "whole", "part", "cut")
    met = lookup_join(keyed, plan, ["src", "no_src"])
    extra = F.when((F.col("part") > 0) & (rank <= F.col("cut")), F.lit(1)).otherwise(F.lit(0))
    taken = (F.col("size") * (F.col("whole") + extra)).cast("long")
    return met.select("row.*", "size", "source_size", "target", taken.alias("taken"))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS no_src,
                  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 13) AS BIGINT) AS DOUBLE)
                   + 0.5) / 4503599627370496.0 AS u FROM documents),
s AS (SELECT src, no_src, sum(size) AS ss, [3, 1, 2][CAST((row_number() OVER (ORDER BY no_src, src) - 1) % 3 + 1 AS BIGINT)] AS w FROM d GROUP BY src, no_src),
r AS (SELECT *, CAST(ss AS DOUBLE) * 2.0 AS room FROM s),
l AS (SELECT *, (CAST(sum(ss) OVER () AS DOUBLE) * 1.5 - coalesce(sum(room) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
      FROM r WINDOW b AS (ORDER BY room / w, no_src, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT src, no_src, CAST(ss AS BIGINT) AS source_size,
             CASE WHEN room / w <= level THEN room ELSE max(CASE WHEN room / w > level THEN level END) OVER () * w END AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
q AS (SELECT *, floor(ratio) AS whole, ratio - floor(ratio) AS part, target - floor(ratio) * source_size AS due FROM p),
k AS (SELECT d.*, q.source_size, q.target, q.whole, q.part, q.due,
             CASE WHEN q.part > 0 THEN (u / (1 - u)) / (q.part / (1 - q.part)) END AS rnk
      FROM d JOIN q ON d.src = q.src AND d.no_src = q.no_src),
c AS (SELECT src, no_src, rnk, any_value(due) AS due, sum(sum(size)) OVER (PARTITION BY src, no_src ORDER BY rnk) AS run
      FROM k WHERE part > 0 AND size > 0 GROUP BY src, no_src, rnk),
e AS (SELECT src, no_src, rnk, run, due FROM c UNION ALL SELECT DISTINCT src, no_src, -1.0, 0, due FROM c),
x AS (SELECT src, no_src, arg_min(rnk, [abs(CAST(run AS DOUBLE) - due), CAST(run AS DOUBLE)]) AS cut FROM e GROUP BY src, no_src)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN part > 0 AND rnk <= cut THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k LEFT JOIN x ON k.src = x.src AND k.no_src = x.no_src"""

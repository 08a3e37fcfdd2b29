"""Joining a big table to a small keyed table without trusting luck.

Terms and labels are hot keys: one of them may hold a third of all rows. Every
join of rows or cells to a per-term or per-label table goes through here. The
small side is written and measured first. Below the limits it is broadcast; above them
the join shuffles, and Spark must not broadcast it on a guess. As long as the
small side's copies stay bounded, the big side is salted and the small side
repeated once per salt, so that no key lands in one task; a larger one is
shuffled once, and adaptive execution splits the partition of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.scratch import Written, width_in_bytes, write_table

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32
#: Rows of a small side with all its copies; one that has more of its own is not repeated.
REPEATED_ROWS = 2_000_000


def measured(df: DataFrame) -> Written:
    """A table that is already stored, with its size from one aggregate over it."""
    size = df.agg(F.count("*").alias("n"), F.sum(width_in_bytes(df)).alias("b")).first()
    return Written(df, size["n"], size["b"] or 0)


def fits_broadcast(written: Written) -> bool:
    return written.rows <= BROADCAST_ROWS and written.width <= BROADCAST_BYTES


def salts_for(rows: int) -> int:
    """How many salts a small side of so many rows may be repeated for."""
    return max(1, min(SALTS, REPEATED_ROWS // max(1, rows)))


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str, salts: int = SALTS) -> DataFrame:
    """Equi-join in which each key of ``big`` is spread over ``salts`` tasks.

    The hint keeps Spark from broadcasting the copies: it estimates them by the
    size of the file that holds one.
    """
    if salts == 1:
        return big.join(small.hint("merge"), list(keys), how)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(salts)).cast("int")
    salted = big.withColumn("_salt", spread)
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    big: DataFrame,
    small: DataFrame | Written,
    keys: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join ``big`` to ``small`` (one row per key) by a measured strategy.

    ``how`` is inner, left, left_semi or left_anti, always keeping ``big`` on
    the left, the side that Spark streams when it broadcasts the other.
    """
    keys = list(keys)
    if not isinstance(small, Written):
        only_keys = how in ("left_semi", "left_anti")
        small = write_table(small.select(*keys).distinct() if only_keys else small, "lookup")
    if fits_broadcast(small):
        return big.join(F.broadcast(small.table), keys, how)
    return salted_join(big, small.table, keys, how, salts_for(small.rows))


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the statistics of a row's group, or the single global row, as columns."""
    if by:
        return lookup_join(df, stats, by)
    names = stats.columns
    one_row = stats.select(F.struct(*names).alias("_stats")).scalar()
    return df.withColumn("_stats", one_row).select(*df.columns, *[F.col(f"_stats.{n}").alias(n) for n in names])

"""Joins and rankings that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 16
BROADCAST_ROWS = 50_000
GROUP_LIMIT = 1_000  # default of spark.sql.optimizer.windowGroupLimitThreshold
_SALT = "_salt"


def _row_salt(df: DataFrame, salts: int) -> Column:
    """A number that spreads rows evenly, copies of one row included.

    The hash spreads different rows, the partition number spreads copies. Both come out
    the same when a lost task is run again, unlike a random number.
    """
    atomic = [f"`{n}`" for n, t in df.dtypes if "map<" not in t and "variant" not in t]
    return F.pmod(F.xxhash64(*atomic) + F.spark_partition_id(), F.lit(salts)).cast("int")


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Checked size: does ``df`` have at most ``rows`` rows?"""
    return df.limit(rows + 1).count() <= rows


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join a fact table to a lookup whose keys are unique.

    No side is broadcast by decree: adaptive execution turns the join into a
    broadcast when the lookup's measured size allows it, and else splits the fact rows
    of a hot key over tasks (inner, left, semi and anti joins). The lookup, which may
    be as large as the facts, is never copied.
    """
    return facts.join(lookup, list(on), how)


def reference_join(
    facts: DataFrame, reference: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join to a stored reference table: broadcast after a size check, else salted."""
    if small_enough(reference):
        return facts.join(F.broadcast(reference), list(on), how)
    return lookup_join(facts, reference, on, how)


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    salts: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank.

    A hot group is never sorted whole by one task. Up to ``GROUP_LIMIT`` Spark itself
    cuts every map task's share of a group to ``n`` rows before the shuffle (window
    group limit). Beyond that the group is first ranked in salted parts, and only the
    parts' first ``n`` rows are ranked together. The number of parts follows the shuffle partitions.
    """
    if n > GROUP_LIMIT:
        salts = salts or max(DEFAULT_SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
        part = Window.partitionBy(*keys, _SALT).orderBy(*order)
        df = (
            df.withColumn(_SALT, _row_salt(df, salts))
            .withColumn(rank, F.row_number().over(part))
            .where(F.col(rank) <= n)
            .drop(rank, _SALT)
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= n)

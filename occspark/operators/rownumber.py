"""Row numbers and running sums over a global order, none of it in a single task.

Rows are range partitioned by the order and sorted inside their partitions. A row's number is the
size of the partitions before its own plus its place in it, a running sum likewise. Only one number
per partition (and key) is summed in sequence. Rows that tie are ordered by a hash of the whole row
and, if they are copies, by where they were read, so one order value on a third of all rows still
spreads over partitions. The sorted rows are checkpointed, as number and base must come from one and
the same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from occspark.session import cut_lineage

#: Bits of ``monotonically_increasing_id`` below the partition number.
_PLACE_BITS = 33


def free_name(df: DataFrame, wanted: str, *others: str) -> str:
    """``wanted``, with underscores put before it until no column has that name."""
    taken = {c.lower() for c in (*df.columns, *others)}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def _column(c: str | Column) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def range_sorted(df: DataFrame, order: Sequence[str | Column], at: str) -> DataFrame:
    """The rows in global order, checkpointed; ``at`` grows along it: partition number and place within."""
    tie, copy = free_name(df, "_tie", at), free_name(df, "_copy", at)
    atomic = [f"`{n}`" for n, t in df.dtypes if "map<" not in t and "variant" not in t]
    keys = [*map(_column, order), F.col(tie).asc(), F.col(copy).asc()]
    rows = df.withColumns({tie: F.xxhash64(*atomic), copy: F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie, copy)
    return cut_lineage(ordered.withColumn(at, F.monotonically_increasing_id()))


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Every row with its number, from 1, in the global order (names sort ascending, nulls last)."""
    at = free_name(df, "_at", name)
    place, base = free_name(df, "_place", name), free_name(df, "_base", name)
    rows = range_sorted(df, order, at).withColumn(place, F.shiftright(at, _PLACE_BITS))
    before = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(place).agg(F.count(F.lit(1)).alias(base))
    # One row per partition, so its size is bounded by the shuffle partitions.
    bases = sizes.select(place, F.coalesce(F.sum(base).over(before), F.lit(0)).alias(base))
    within = F.col(at).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = rows.join(F.broadcast(bases), place)
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(base) + within + 1).alias(name))


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str = "before"
) -> DataFrame:
    """Every row with the sum of ``value`` over the rows before it within its key; 0 for the first.

    A key that holds most of the rows lies in many range partitions: each of them is summed by
    itself, and its base is the sum of the key's earlier partitions.
    """
    at = free_name(df, "_at", name)
    place, base, run = (free_name(df, c, name) for c in ("_place", "_base", "_run"))
    rows = range_sorted(df, [*keys, *order], at).withColumn(place, F.shiftright(at, _PLACE_BITS))
    earlier = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*keys, place).agg(F.sum(value).alias(base))
    bases = parts.select(*keys, place, F.coalesce(F.sum(base).over(earlier), F.lit(0)).alias(base))
    before = Window.partitionBy(*keys, place).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn(run, F.coalesce(F.sum(value).over(before), F.lit(0)))
    renamed = [free_name(df, f"_{k}_of_base", name) for k in keys]
    bases = bases.withColumnsRenamed(dict(zip(keys, renamed, strict=True)) | {place: f"{place}_of_base"})
    same = F.col(place) == F.col(f"{place}_of_base")
    for key, other in zip(keys, renamed, strict=True):
        same &= F.col(key).eqNullSafe(F.col(other))
    return summed.join(bases, same).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col(run) + F.col(base)).alias(name)
    )


#: Rows that a sort with a limit may merge in one task.
ONE_TASK_ROWS = 10_000


def largest_rows(
    df: DataFrame, measure: str, ties: Sequence[str | Column], limit: int, one_task: int = ONE_TASK_ROWS
) -> DataFrame:
    """The ``limit`` rows with the largest measure in order; ``ties`` decide between equals.

    A sort with a limit merges that many rows in one task. Beyond ``one_task`` rows are counted per
    measure value instead, which gives the value at the limit: all rows above it are in, and of the rows
    that have just this value the first by ``ties``, by their distributed row numbers.
    """
    order = [F.col(measure).desc(), *map(_column, ties)]
    if limit <= one_task:
        return df.orderBy(*order).limit(limit)
    df = cut_lineage(df)
    number, before = free_name(df, "_number"), free_name(df, "_before")
    counts = df.groupBy(measure).agg(F.count(F.lit(1)).alias(number))
    reached = running_sums(counts, [], [F.col(measure).desc()], number, before)
    at = reached.where((F.col(before) < limit) & (F.col(before) + F.col(number) >= limit)).first()
    if at is None:
        return df.orderBy(*order)
    above = df.where(F.col(measure) > at[measure])
    equal = row_numbers(df.where(F.col(measure) == at[measure]), ties, number)
    equal = equal.where(F.col(number) <= limit - at[before]).drop(number)
    return above.unionByName(equal).orderBy(*order)

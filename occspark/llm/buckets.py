"""Compare rows within buckets by streaming sorted partitions, whatever a bucket's size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a bucket that one task compares with each other; larger buckets are cut into parts of about this size.
PART_ROWS = 2_000

GROUP = ("bucket", "part_a", "part_b")


def bucketed(rows: DataFrame, spread: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Rows with a ``bucket`` column, dealt out and sorted so that each group of ``GROUP`` is one run.

    A bucket of up to ``part_rows`` rows is one group. The rows of a larger one are dealt into
    parts by a hash of ``spread``, and each pair of parts is a group of its own: every pair of rows
    meets exactly once, if pairs of one part are taken only where ``part_a = part_b``. No pair is dropped.
    """
    large = (
        rows.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > part_rows)
        .select("bucket", F.ceil(F.col("n") / part_rows).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    dealt = (
        rows.join(large, "bucket", "left")
        .withColumn("part", F.pmod(F.xxhash64(spread), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("part_a", F.least("part", "other"))
        .withColumn("part_b", F.greatest("part", "other"))
        .drop("parts", "other")
    )
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)


def runs(batches: Iterator[pd.DataFrame], rows: int = 50_000) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Regroup sorted batches so that no group is torn: frames of whole groups and each row's group number.

    Holds one group more than a batch, and groups are bounded by ``bucketed``.
    """
    held: list[pd.DataFrame] = []
    size = 0

    def whole(frame: pd.DataFrame) -> np.ndarray:
        keys = [frame[name].to_numpy() for name in GROUP]
        return np.cumsum(np.concatenate(([0], np.any([k[1:] != k[:-1] for k in keys], axis=0))))

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch)
        if size < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        group = whole(frame)
        keep = int(np.searchsorted(group, group[-1]))
        if keep:
            yield frame.iloc[:keep], group[:keep]
        held = [frame.iloc[keep:].reset_index(drop=True)]
        size = len(held[0])
        rows = max(rows, 2 * size)
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame, whole(frame)


def windows(low: np.ndarray, high: np.ndarray, limit: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with low[i] <= j < high[i], in slices of about ``limit`` pairs."""
    counts = np.maximum(high - low, 0)
    total = np.cumsum(counts)
    at = 0
    while at < len(counts):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        part = counts[at:to]
        left = np.repeat(np.arange(at, to), part)
        yield left, np.arange(len(left)) - np.repeat(np.cumsum(part) - part, part) + np.repeat(low[at:to], part)
        at = to


Compare = Callable[[pd.DataFrame, np.ndarray], Iterator[pd.DataFrame]]

"""Connected components: small forests inside tasks, and stars over the whole edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occspark.llm.store import cut


def forest(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """The smallest reachable index for each of ``count`` vertices."""
    label = np.arange(count)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        label = new[label]
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
    return label


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of the edges (a, b); the root is the smallest vertex reachable.

    Alternates large and small stars (Kiveris et al., 2014): each round links every vertex to the
    smallest vertex it sees, so the number of rounds follows the logarithm of the longest chain.
    Per vertex only a minimum is aggregated, and the joins that deal it out are left to adaptive
    execution, which splits a vertex with very many edges. Each round is checkpointed.
    """
    edges = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark or now[0] == 0:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        mark = now
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = cut(small.distinct())

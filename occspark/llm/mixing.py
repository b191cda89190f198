"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents are counted once into cells (source, language, topic) with their tokens; everything
iterative happens on the cells. A sweep rescales the cells' token weights so that each margin in
turn meets its target; sweeps end when no factor differs from 1 by more than ``TOLERANCE``. A
document's weight is its cell's fitted tokens over the cell's tokens, and its probability is that
weight over the largest one, so the expected sample meets every margin to within ``deviation``, which is
returned: more than ``TOLERANCE`` only if targets contradict each other or the sweeps ran out. A document is drawn
if a hash of its identifier and text falls below its probability: repeatable, and equal for equal rows.

With a budget (tokens of the sample over tokens of the input) a document is expected weight * budget times: the whole
part of that, and once more if the hash falls below the fraction. Margins are met in expectation and the sample's size
is the budget's, however rare a cell is: its documents are repeated and no others are dropped for it.

Targets default to tempered shares, tokens ** ``TEMPER``, per margin. A value that a given target doesn't list
gets no weight. Cells with no tokens keep weight 1 of 1, so empty texts are drawn like their cell's others.

The tables have no topic, so ``topic`` sorts documents by the hash class that most of their longer
words fall in; any other topic column can be given instead.

Defined cases: null sources, languages and texts are values of their own (null text: no words, topic 0);
an empty table gives an empty result; repeated rows are drawn or left together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.llm.decontaminate import lowered
from occspark.llm.langid import fresh
from occspark.llm.store import bound_batches, cut, stored
from occspark.llm.words import PUNCTUATION, SPACES, blocks, utf8, words

TEMPER = 0.7
TOPICS = 8
TOLERANCE = 1e-6
SWEEPS = 50
LONG_WORD = 5


def measures_of(texts: pa.Array, topics: int = TOPICS) -> tuple[np.ndarray, np.ndarray]:
    """Words between white space, and the class of most long words (the smallest of equals; 0 without any)."""
    tokens = np.zeros(len(texts), dtype=np.int64)
    classes = np.zeros((len(texts), topics), dtype=np.int64)
    for block in blocks(*utf8(texts), SPACES, 0):
        tokens[block.rows] += np.diff(words(block, SPACES).first)
    for block in blocks(*lowered(texts), PUNCTUATION, 0):
        w = words(block, PUNCTUATION)
        row = np.repeat(block.rows, np.diff(w.first))
        kind = (w.hashes() % np.uint64(topics)).astype(np.int64)
        long = w.ends - w.starts >= LONG_WORD
        classes += np.bincount(row[long] * topics + kind[long], minlength=classes.size).reshape(classes.shape)
    return tokens, classes.argmax(axis=1)


def measures(text: Column) -> Column:
    """A struct of token count and topic."""

    @F.pandas_udf("tokens long, topic int")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, topic = measures_of(pa.array(batch, pa.string()))
            yield pd.DataFrame({"tokens": tokens, "topic": topic.astype(np.int32)})

    return compute(text.cast("string"))


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """(margin, share): token shares raised to ``power`` and made to add up to 1 again.

    Each margin is tempered by itself, so where cells are missing the targets may contradict each other.
    """
    totals = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), power).alias("raw"))
    whole = totals.agg(F.sum("raw").alias("whole"))
    # One row; a join with it is a broadcast of 8 bytes.
    return totals.join(F.broadcast(whole)).select(margin, (F.col("raw") / F.col("whole")).alias("share"))


def rake(
    cells: DataFrame,
    margins: list[str],
    targets: dict[str, DataFrame] | None = None,
    sweeps: int = SWEEPS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Cells with ``weight``, the tokens that meet all targets. ``cells`` has the margins (no nulls) and tokens.

    ``deviation`` is the largest share by which a margin still missed its target in the last sweep: at most
    ``tolerance``, unless the targets contradict each other or ``sweeps`` ran out.
    """
    targets = targets or {}
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return now.withColumn("deviation", F.lit(0.0))
    shares = {m: fresh(cells, f"_share_{m}") for m in margins}
    for m in margins:
        target = targets.get(m) or tempered(cells, m)
        now = now.join(target.select(m, F.col("share").alias(shares[m])), m, "left").fillna(0.0, [shares[m]])
    now = cut(now)
    for _ in range(sweeps):
        factors = []
        for m in margins:
            sums = now.groupBy(m).agg(F.sum("weight").alias("_sum"))
            now = now.join(sums, m).withColumn(
                f"_f_{m}", F.when(F.col("_sum") > 0, F.col(shares[m]) * total / F.col("_sum")).otherwise(1.0)
            )
            now = now.withColumn("weight", F.col("weight") * F.col(f"_f_{m}")).drop("_sum")
            factors.append(f"_f_{m}")
        now = cut(now)
        moved = now.where("weight > 0").agg(F.max(F.greatest(*[F.abs(F.col(f) - 1) for f in factors]))).first()[0]
        now = now.drop(*factors)
        if moved is None or moved <= tolerance:
            break
    return now.drop(*shares.values()).withColumn("deviation", F.lit(float(moved or 0.0)))


def probabilities(
    docs: DataFrame,
    margins: tuple[str, ...] = ("source", "lang"),
    rate: float = 1.0,
    targets: dict | None = None,
    budget: float | None = None,
) -> DataFrame:
    """(doc_id, source.., topic, tokens, weight, probability, kept) for every row of documents.

    ``rate`` scales the probabilities down (1 draws as many tokens as the targets allow). With ``budget`` there is
    ``draws`` as well, ``kept`` means one draw or more, and ``probability`` is that of being kept.
    """
    bound_batches(docs.sparkSession)
    raw = [F.concat(F.lit("v"), F.col(m).cast("string")) for m in margins]
    base = docs.select(
        "doc_id",
        *[F.coalesce(r, F.lit("n")).alias(f"_{m}") for r, m in zip(raw, margins, strict=True)],
        measures(F.col("text")).alias("_m"),
        (F.pmod(F.xxhash64("doc_id", F.col("text").cast("string")), F.lit(1 << 50)) / float(1 << 50)).alias("_draw"),
    )
    base = stored(base.select("*", F.col("_m.tokens").alias("tokens"), F.col("_m.topic").alias("_topic")).drop("_m"))
    keys = [f"_{m}" for m in margins] + ["_topic"]
    cells = cut(base.groupBy(*keys).agg(F.sum("tokens").alias("tokens")))
    fitted = rake(cells, keys, targets)
    weight = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0)
    fitted = cut(fitted.select(*keys, weight.alias("weight"), "deviation"))
    most = fitted.agg(F.max("weight")).first()[0] or 1.0
    times = F.col("weight") / most * rate if budget is None else F.col("weight") * (rate * budget)
    found = base.join(fitted, keys).withColumn("probability", F.least(F.lit(1.0), times))
    draws = (F.floor(times) + (F.col("_draw") < times - F.floor(times)).cast("long")).alias("draws")
    kept = (F.col("_draw") < F.col("probability")).alias("kept")
    return found.select(
        "doc_id",
        *[F.expr(f"if(`_{m}` = 'n', null, substr(`_{m}`, 2))").alias(m) for m in margins],
        F.col("_topic").alias("topic"),
        "tokens",
        "weight",
        "deviation",
        "probability",
        kept,
        *([] if budget is None else [draws]),
        "_draw",
    )


def mix(docs: DataFrame, budget: float | None = None) -> DataFrame:
    return probabilities(docs, budget=budget).drop("_draw")


def sample(docs: DataFrame, rate: float = 1.0, budget: float | None = None) -> DataFrame:
    """The drawn documents, with ``budget`` once per draw; columns unchanged. Equal rows are drawn or left together."""
    drawn = probabilities(docs, rate=rate, budget=budget).where("kept")
    taken = {n: fresh(docs, f"_{n}_drawn") for n in ("doc_id", "source", "lang", "_draw", "draws")}
    draw, number = fresh(docs, "_draw"), fresh(docs, "_number")
    copies = F.lit(1).cast("long") if budget is None else F.col("draws")
    chosen = drawn.withColumn("draws", copies).select(*[F.col(n).alias(m) for n, m in taken.items()]).distinct()
    own = F.pmod(F.xxhash64("doc_id", F.col("text").cast("string")), F.lit(1 << 50)) / float(1 << 50)
    same = (F.col(draw) == F.col(taken["_draw"])) & F.col("doc_id").eqNullSafe(F.col(taken["doc_id"]))
    for n in ("source", "lang"):
        same = same & F.col(n).cast("string").eqNullSafe(F.col(taken[n]))
    found = docs.withColumn(draw, own).join(chosen, same)
    if budget is not None:
        found = found.withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.col(taken["draws"]))))
    return found.drop(draw, number, *taken.values())

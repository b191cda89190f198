"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader (FTRL-proximal) under an elastic-net penalty, then
calibrated by a temperature.

Corpus statistics (rows per language, document frequency of every n-gram bucket) come from all
learning rows. Only the gradient steps use a sample, of about ``SAMPLE_ROWS`` rows at most,
balanced over the languages and chosen by a hash of text and language.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text when
there is nothing to learn from; null languages are not learnt; repeated rows count each time; rows
with a null ``doc_id`` are learnt from (their hash counts as 0). Texts are used whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.llm.store import bound_batches

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SAMPLE_ROWS = 2_400
MAX_LANGUAGES = 512
UNDETERMINED = "und"

#: FTRL: step size, its offset, weights of the l1 and l2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.1, 3

_LETTER = np.zeros(128, dtype=bool)
_LETTER[97:123] = True
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)
_CODE_POINTS = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket of 1- to 3-grams occurs. Non-letters count as one kind of space."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(text), _CODE_POINTS):
        # Two characters of the part before, so that no n-gram is lost at a cut.
        back = min(at, 2)
        part = text[at - back : at + _CODE_POINTS].lower()
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ascii_points = points < 128
        points = np.where(ascii_points & ~_LETTER[np.where(ascii_points, points, 0)], np.uint32(32), points)
        for size in (1, 2, 3):
            skip = max(0, back - size + 1)
            if len(points) - skip < size:
                continue
            grams = np.full(len(points) - skip - size + 1, size * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
            for place in range(size):
                grams = (grams ^ points[skip + place : len(points) - size + 1 + place]) * _MULTIPLIERS[place]
                grams ^= grams >> np.uint32(15)
            total += np.bincount(grams >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    return total


def frequencies(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur and the logarithm of how often."""
    counts = bucket_counts(text)
    index = np.flatnonzero(counts)
    return index, 1 + np.log(counts[index])


@dataclass
class Model:
    """Weights per bucket and language; ``idf`` of the corpus; ``temperature`` of the calibration."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, index: np.ndarray, values: np.ndarray) -> np.ndarray:
        values = values * self.idf[index]
        norm = np.sqrt(values @ values)
        return values / norm if norm else values

    def logits(self, index: np.ndarray, values: np.ndarray) -> np.ndarray:
        return self.vector(index, values) @ self.weights[index] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        logits = self.logits(*frequencies(text)) / self.temperature
        shares = np.exp(logits - logits.max())
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best] / shares.sum())


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the identifier's text falls into the fold that is not learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def document_frequencies(rows: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts. Tasks add up before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, texts = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for value in batch["t"]:
                total += bucket_counts(value) > 0
            texts += len(batch)
        index = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(index, -1), "n": np.append(total[index], texts)})

    counted = (
        rows.select(F.coalesce(text, F.lit("")).alias("t"))
        .mapInPandas(count, "bucket int, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # one row per bucket at most
    )
    totals = dict(zip(counted["bucket"], counted["n"], strict=True))
    texts = int(totals.pop(-1, 0))
    df = np.zeros(BUCKETS)
    df[list(totals)] = list(totals.values())
    return df, texts


def fit(
    rows: DataFrame,
    text: str = "text",
    label: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Learn from all rows with a label. ``sample_rows`` bounds the rows of the gradient steps.

    A model has a column of weights per language, so ``max_languages`` bounds them: labels beyond that
    many with most rows (ties by name) count for document frequencies but are never predicted.
    """
    bound_batches(rows.sparkSession)
    rows = rows.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label")).where("label is not null")
    counts = {
        r["label"]: r["n"]
        for r in rows.groupBy("label")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "label")
        .limit(max_languages)
        .collect()
    }
    languages = sorted(counts)
    df, texts = document_frequencies(rows, "text")
    idf = np.log((1 + texts) / (1 + df)) + 1
    model = Model(languages, idf, np.zeros((BUCKETS, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model
    each = max(2, sample_rows // len(languages))
    rates = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, each / counts[name]))])
    draw = F.pmod(F.xxhash64("text", "label"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.where(draw < rates[F.col("label")])

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [frequencies(value) for value in batch["text"]]
            yield pd.DataFrame(
                {
                    "label": batch["label"],
                    "draw": batch["draw"],
                    "index": [x.astype(np.int16).tobytes() for x, _ in found],
                    "value": [x.astype(np.float32).tobytes() for _, x in found],
                }
            )

    drawn = (
        sample.select(F.coalesce("text", F.lit("")).alias("text"), "label", draw.alias("draw"))
        .mapInPandas(features, "label string, draw double, index binary, value binary")
        .toPandas()  # bounded by sample_rows
        .sort_values(["draw", "label", "value"])
    )
    if not len(drawn):
        return model
    examples = [
        (np.frombuffer(i, dtype=np.int16).astype(np.int64), np.frombuffer(v, dtype=np.float32).astype(float))
        for i, v in zip(drawn["index"], drawn["value"], strict=True)
    ]
    answers = np.searchsorted(languages, drawn["label"].to_numpy(dtype=object))
    order = np.random.default_rng(10).permutation(len(examples))
    fifth = len(order) // 5
    calibrate, learn = order[:fifth], order[fifth:]
    _descend(model, [examples[i] for i in learn], answers[learn])
    if fifth >= 10:
        logits = np.array([model.logits(*examples[i]) for i in calibrate])
        model.temperature = _temperature(logits, answers[calibrate])
    return model


def _descend(model: Model, examples: list, answers: np.ndarray) -> None:
    """FTRL-proximal with per-coordinate steps (McMahan et al., 2013) on the softmax loss."""
    width = len(model.languages)
    z, n = np.zeros((BUCKETS + 1, width)), np.zeros((BUCKETS + 1, width))

    def weights(index) -> np.ndarray:
        part = z[index]
        return np.where(
            np.abs(part) <= L1, 0.0, (np.sign(part) * L1 - part) / ((BETA + np.sqrt(n[index])) / ALPHA + L2)
        )

    draw = np.random.default_rng(11)
    for _ in range(PASSES):
        for at in draw.permutation(len(examples)):
            index, values = examples[at]
            values = np.append(model.vector(index, values), 1.0)
            index = np.append(index, BUCKETS)
            w = weights(index)
            logits = values @ w
            shares = np.exp(logits - logits.max())
            shares /= shares.sum()
            shares[answers[at]] -= 1
            gradient = values[:, None] * shares
            step = (np.sqrt(n[index] + gradient**2) - np.sqrt(n[index])) / ALPHA
            z[index] += gradient - step * w
            n[index] += gradient**2
    final = weights(slice(None))
    model.weights, model.bias = final[:-1], final[-1]


def _temperature(logits: np.ndarray, answers: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section between 1/50 and 50.

    Answers count as right with the chance (n + 1) / (n + 2), so that a faultless sample doesn't give certainty.
    """
    doubt = 1 / (len(answers) + 2)

    def loss(power: float) -> float:
        scaled = logits / np.exp(power)
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        wanted = (1 - doubt) * scaled[np.arange(len(answers)), answers] + doubt * scaled.mean(axis=1)
        return float(np.mean(np.log(np.exp(scaled).sum(axis=1)) - wanted))

    low, high, ratio = -np.log(50), np.log(50), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def prediction(model: Model, text: Column) -> Column:
    """A struct of language and calibrated score of a text column."""

    @F.pandas_udf("lang string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang", "score"])

    return predict(text)


def identify(docs: DataFrame) -> DataFrame:
    """Language of every document, learnt from its own labelled part outside the held-out fold."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), prediction(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Documents whose language was found with a calibrated probability of ``min_score`` or more; columns unchanged."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    name = fresh(docs, "_language")
    return docs.withColumn(name, prediction(model, F.col("text"))).where(F.col(name)["score"] >= min_score).drop(name)


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name

"""Toxicity: nearest labelled examples by exact TF-IDF cosine, found in block-max inverted indexes.

Terms are the words of the lower-cased texts; every word of the examples is indexed, and document frequencies
come from all documents. Examples are a sample of about ``SAMPLE_ROWS`` labelled documents, balanced over the
labels and chosen by a hash.

The index keeps, per term, postings in blocks of ``BLOCK`` examples and each block's largest weight.
Words in ``COMMON`` of the examples or more are columns of a dense matrix instead, multiplied for ``TOGETHER`` texts
at once. For a text, the blocks' bounds (largest dense part, plus query weights times block maxima) are taken in
falling order, in growing waves, until the next bound is below the k-th best cosine, so the k nearest are exact
(cosines are rounded to 12 decimals, so that equal examples tie). They vote with weight
1 / (distance + 0.05), times 1 + ``STRESS`` times the square of the part of the cosine that comes from words which
depend on the label (by chi-square in the sample). The label has no say in which examples are nearest. Votes are
calibrated by a logistic curve, fitted to the examples' own votes with each left out and weighted to the true
share of labels. A text without any neighbour has the score of the examples without one. The nearest examples
are returned as evidence. The vote was chosen by cross-validation over the four learning folds.

Defined cases: null and empty texts have no neighbour; without usable labels all scores are 0; a
document with contrary labels counts as toxic; labels of unknown documents are ignored; repeated rows repeat results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occspark.llm.decontaminate import lowered, present, sieve
from occspark.llm.langid import held_out
from occspark.llm.store import bound_batches
from occspark.llm.words import PUNCTUATION, blocks, words

SAMPLE_ROWS = 4_000
CHI_SQUARE = 30.0
CHANCE = 3.84
STRESS = 1e5
NEAREST = 31
BLOCK = 64
COMMON = 0.05
TOGETHER = 64
EVIDENCE = 3


def term_counts(texts: pa.Array, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (row, term, count); terms are places in the sorted ``wanted``, or hashes if that is None."""
    table = None if wanted is None else sieve(wanted)
    rows, terms, counts = [], [], []
    for block in blocks(*lowered(texts), PUNCTUATION, 0):
        w = words(block, PUNCTUATION)
        hashes = w.hashes()
        row = np.repeat(block.rows, np.diff(w.first))
        if wanted is not None:
            at, hashes = present(hashes, table, wanted) if len(wanted) else (np.zeros(0, int), np.zeros(0, int))
            row = row[at]
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])))) if len(row) else row
        rows.append(row[new])
        terms.append(hashes[new])
        counts.append(np.diff(np.append(new, len(row))))
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    row, term, count = np.concatenate(rows), np.concatenate(terms), np.concatenate(counts)
    # Parts of one long text are added up.
    order = np.lexsort((term, row))
    row, term, count = row[order], term[order], count[order]
    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])))) if len(row) else row
    return row[new], term[new], np.add.reduceat(count, new) if len(new) else count


def association(docs: np.ndarray, terms: np.ndarray, toxic: np.ndarray, width: int) -> np.ndarray:
    """How much the presence of each of ``width`` terms depends on the label, from 0 to 1; ``docs`` index ``toxic``."""
    a = np.bincount(terms, weights=toxic[docs], minlength=width)
    n = np.bincount(terms, minlength=width)
    ones, total = toxic.sum(), len(toxic)
    b, c = n - a, ones - a
    d = total - ones - b
    below = np.maximum(1.0 * n * (total - n) * ones * (total - ones), 1e-9)
    chi = total * (a * d - b * c) ** 2 / below
    return np.where((chi >= CHANCE) & (n > 1), (chi / (chi + CHI_SQUARE)) ** 2, 0.0)


def spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places first[i] <= p < last[i], and the i of each."""
    length = last - first
    owner = np.repeat(np.arange(len(length)), length)
    return np.arange(len(owner)) + (first - np.cumsum(length) + length)[owner], owner


@dataclass
class Index:
    """Postings by term and block, and what a vote needs to know of the examples.

    ``runs`` has, per term, its first non-empty block among ``block``, ``start`` (of postings) and ``most`` (largest weight).
    Common terms have no postings but a row of ``dense``, named by ``row_of`` (others: -1).
    ``own`` has, per example, its first among ``own_terms``, those that depend on the label, and ``own_weights``.
    """

    vocabulary: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    runs: np.ndarray
    block: np.ndarray
    start: np.ndarray
    most: np.ndarray
    row_of: np.ndarray
    dense: np.ndarray
    own: np.ndarray
    own_terms: np.ndarray
    own_weights: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)
    alone: float = 0.0

    def vectors(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
        """TF-IDF weights of sorted (row, term, count), each row of length 1."""
        weight = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(row, weights=weight**2, minlength=rows))
        return weight / norm[row] if len(row) else weight

    def common(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
        """What common terms add to the cosine of each row to each example."""
        texts = np.zeros((rows, len(self.dense)))
        at = np.flatnonzero(self.row_of[term] >= 0)
        texts[row[at], self.row_of[term[at]]] = weight[at]
        return texts @ self.dense

    def nearest(self, term: np.ndarray, weight: np.ndarray, without: int = -1, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``NEAREST`` examples with a positive cosine: highest cosine, then lowest number, first.

        ``base`` is the text's row of ``common``, if it is known.
        """
        if base is None:
            base = self.common(np.zeros(len(term), dtype=np.int64), term, weight, 1)[0]
        run, owner = spans(self.runs[term], self.runs[term + 1])
        block, size = self.block[run], -(-len(self.ids) // BLOCK)
        bounds = np.bincount(block, weights=self.most[run] * weight[owner], minlength=size)
        bounds = bounds + (np.maximum.reduceat(base, np.arange(0, len(base), BLOCK)) if len(base) else 0)
        order = np.argsort(-bounds, kind="stable")
        order = order[: np.count_nonzero(bounds > 0)]
        best_score, best = np.zeros(0), np.zeros(0, dtype=np.int64)
        at, wave = 0, 1 + size // 2
        while at < len(order):
            # Rounding may leave a bound a little below a cosine that it bounds.
            if len(best) == NEAREST and bounds[order[at]] + 1e-9 < best_score[-1]:
                break
            chosen = np.zeros(size, dtype=bool)
            chosen[order[at : at + wave]] = True
            taken = np.flatnonzero(chosen[block])
            place, of = spans(self.start[run[taken]], self.start[run[taken] + 1])
            added = self.weights[place] * weight[owner[taken]][of]
            scores = np.bincount(self.examples[place], weights=added, minlength=len(self.ids))
            scores = (scores + base) * np.repeat(chosen, BLOCK)[: len(base)]
            if without >= 0:
                scores[without] = 0
            least = np.partition(scores, -NEAREST)[-NEAREST] if len(scores) > NEAREST else 0.0
            found = np.flatnonzero((scores > 0) & (scores >= least - 1e-9))
            best = np.concatenate((best, found))
            best_score = np.concatenate((best_score, np.round(scores[found], 12)))
            kept = np.lexsort((best, -best_score))[:NEAREST]
            best, best_score = best[kept], best_score[kept]
            at, wave = at + wave, 2 * wave
        return best, best_score

    def told(self, term: np.ndarray, weight: np.ndarray, best: np.ndarray) -> np.ndarray:
        """The part of the cosine to each of ``best`` that comes from terms in the measure they depend on the label."""
        place, owner = spans(self.own[best], self.own[best + 1])
        wanted = self.own_terms[place]
        at = np.minimum(np.searchsorted(term, wanted), len(term) - 1)
        added = np.where(term[at] == wanted, weight[at] * self.own_weights[place], 0.0)
        return np.bincount(owner, weights=added, minlength=len(best))

    def vote(self, best: np.ndarray, cosines: np.ndarray, told: np.ndarray) -> float:
        votes = (1 + STRESS * (told / cosines) ** 2) / (1.05 - np.minimum(cosines, 1))
        return float((votes @ self.toxic[best]) / votes.sum())

    def score(self, best: np.ndarray, cosines: np.ndarray, told: np.ndarray) -> float:
        if not len(best):
            return self.alone
        return float(1 / (1 + np.exp(-(self.curve[0] * self.vote(best, cosines, told) + self.curve[1]))))


def build(
    vocabulary: np.ndarray, df: np.ndarray, documents: int, row: np.ndarray, term: np.ndarray, count: np.ndarray,
    ids: np.ndarray, toxic: np.ndarray, share: float,
) -> Index:
    """The index of examples given as sorted (row, term, count); ``share`` is the true share of toxic labels."""
    idf = np.log((1 + documents) / (1 + df)) + 1
    nothing = np.zeros(0)
    index = Index(vocabulary, idf, ids, toxic, *[nothing] * 11)
    weight = index.vectors(row, term, count, len(ids))
    often = np.bincount(term, minlength=len(vocabulary)) >= max(2, COMMON * len(ids))
    index.row_of = np.where(often, np.cumsum(often) - 1, -1)
    index.dense = np.zeros((int(often.sum()), len(ids)))
    index.dense[index.row_of[term[often[term]]], row[often[term]]] = weight[often[term]]
    order = np.lexsort((row, term))
    order = order[~often[term[order]]]
    index.examples, index.weights = row[order], weight[order]
    size = -(-max(1, len(ids)) // BLOCK)
    pair = term[order] * size + row[order] // BLOCK
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    index.runs = np.searchsorted(pair[first], np.arange(len(vocabulary) + 1) * size)
    index.block, index.start = pair[first] % size, np.append(first, len(pair))
    index.most = np.maximum.reduceat(index.weights, first) if len(first) else nothing
    share_of = association(row, term, toxic, len(vocabulary))[term]
    own = np.flatnonzero(share_of)
    index.own = np.searchsorted(row[own], np.arange(len(ids) + 1))
    index.own_terms, index.own_weights = term[own], weight[own] * share_of[own]
    _calibrate(index, row, term, weight, share)
    return index


def _calibrate(index: Index, row: np.ndarray, term: np.ndarray, weight: np.ndarray, share: float) -> None:
    """Fit the curve to the votes of the examples, each without itself, by weighted logistic regression."""
    y = index.toxic
    ones = max(1.0, float(y.sum()))
    importance = np.where(y == 1, share / ones, (1 - share) / max(1.0, len(y) - ones)) * len(y)
    cuts = np.searchsorted(row, np.arange(len(y) + 1))
    votes = np.full(len(y), np.nan)
    for at in range(len(y)):
        part = slice(cuts[at], cuts[at + 1])
        best, cosines = index.nearest(term[part], weight[part], without=at)
        if len(best):
            votes[at] = index.vote(best, cosines, index.told(term[part], weight[part], best))
    alone = np.isnan(votes)
    index.alone = float((importance[alone] @ y[alone] + share) / (importance[alone].sum() + 1)) if len(y) else 0.0
    x, t, w = votes[~alone], y[~alone].astype(float), importance[~alone]
    a, b = 4.0, -2.0
    for _ in range(50):  # Newton, with a small penalty towards the start
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([w @ ((p - t) * x) + 0.05 * (a - 4), w @ (p - t) + 0.05 * (b + 2)])
        v = w * p * (1 - p)
        h = np.array([[v @ (x * x) + 0.05, v @ x], [v @ x, v.sum() + 0.05]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    index.curve = (float(a), float(b))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Index | None:
    """Learn from labelled documents outside the held-out fold; None if they aren't of both kinds."""
    bound_batches(docs.sparkSession)
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id"), 5, 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    rates = [min(1.0, sample_rows / 2 / totals[k]) for k in (0, 1)]
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    drawn = known.where(draw < F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0]))
    # Bounded by sample_rows, so its broadcast is too.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    examples = texts.join(F.broadcast(drawn), "doc_id")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, count = term_counts(batch.column("text"), None)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            pairs = [np.stack([term[a:b].view(np.int64), count[a:b]]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(pairs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "terms"])

    sample = examples.mapInArrow(counts, "doc_id long, toxic int, terms binary").toPandas()
    sample = sample.drop_duplicates(["doc_id", "terms"]).sort_values(["doc_id", "terms"])
    pairs = [np.frombuffer(t, dtype=np.int64).reshape(2, -1) for t in sample["terms"]]
    if not pairs:
        return None
    row = np.repeat(np.arange(len(pairs)), [p.shape[1] for p in pairs])
    hashes, count = np.concatenate(pairs, axis=1)
    vocabulary, term = np.unique(hashes.view(np.uint64), return_inverse=True)
    df, documents = document_frequencies(texts, vocabulary)
    share = totals[1] / (totals[0] + totals[1])
    return build(vocabulary, df, documents, row, term, count, sample["doc_id"].to_numpy(), sample["toxic"].to_numpy(), share)


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each term of the vocabulary occurs, and the number of documents; over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for batch in batches:
            _, term, _ = term_counts(batch.column("text"), vocabulary)
            total[:-1] += np.bincount(term, minlength=len(vocabulary))
            total[-1] += batch.num_rows
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(len(vocabulary) + 1)
    df[rows["term"]] = rows["n"]
    return df[:-1], int(df[-1])


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for every row of documents."""
    index = fit(docs, labels, sample_rows)
    named = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    evidence = "array<struct<doc_id: long, cosine: double, toxic: int>>"
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int, evidence {evidence}"
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for batch in batches:
            scores, found = np.full(batch.num_rows, index.alone if index else 0.0), [[]] * batch.num_rows
            if index:
                group, base = -1, None
                row, term, count = term_counts(batch.column("text"), index.vocabulary)
                weight = index.vectors(row, term, count, batch.num_rows)
                cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
                for at in np.flatnonzero(np.diff(cuts)):
                    if at // TOGETHER != group:
                        group = at // TOGETHER
                        part = slice(cuts[group * TOGETHER], cuts[min(batch.num_rows, (group + 1) * TOGETHER)])
                        base = index.common(row[part] - group * TOGETHER, term[part], weight[part], TOGETHER)
                    part = slice(cuts[at], cuts[at + 1])
                    best, cosines = index.nearest(term[part], weight[part], base=base[at % TOGETHER])
                    scores[at] = index.score(best, cosines, index.told(term[part], weight[part], best))
                    found[at] = [
                        {"doc_id": int(index.ids[i]), "cosine": float(c), "toxic": int(index.toxic[i])}
                        for i, c in zip(best[:EVIDENCE], cosines[:EVIDENCE], strict=True)
                    ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                    pa.array(found, kind),
                ],
                ["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    return named.mapInArrow(judge, schema)

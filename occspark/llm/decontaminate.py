"""Benchmark decontamination: short test items inside long documents, by MinHash containment.

An item is contained in a document if ``THRESHOLD`` or more of its different 5-word shingles occur
there. Words are runs of ASCII letters, digits and non-ASCII characters of the lower-cased text.

Turning containment into a Jaccard threshold fails here: an item of 30 shingles inside a document
of 20,000 has a similarity near zero however it is partitioned. So the signature is one-sided.
Items are partitioned by size. All items of a partition get a bottom-k MinHash signature whose
length k exceeds the number of shingles that the partition's largest item may miss, so a document
that contains the item has at least one signature shingle: the candidate search loses nothing.
Only rows with a candidate are looked at again: the exact containment of the candidates' shingles,
compared as text, decides.

Different item texts are joined in blocks of about ``BLOCK_SHINGLES`` words; each block is broadcast and
meets every document in one pass without a shuffle. Item identifiers are joined to the hits.

Defined cases: items and documents that are null or have no words match nothing; an item of fewer
than five words has one shingle, all its words; a document that repeats a passage counts it once;
repeated rows of either table each give their own result rows; a null ``item_id`` or ``doc_id`` is kept as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.llm.langid import fresh
from occspark.llm.store import bound_batches
from occspark.llm.words import PUNCTUATION, Words, blocks, combined, utf8, words

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_SHINGLES = 200_000

_FILTER_BITS = 20


@dataclass
class Index:
    """A block of different item texts: signature hashes with their items, and each item's shingles with their hashes."""

    texts: list[str]
    signature: np.ndarray
    signature_items: list[list[int]]
    shingles: list[dict[bytes, int]]
    sizes: list[int]
    threshold: float


def sieve(hashes: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << _FILTER_BITS, dtype=bool)
    table[hashes >> np.uint64(64 - _FILTER_BITS)] = True
    return table


def present(hashes: np.ndarray, table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of hashes that are in the sorted ``wanted``, and their places there."""
    at = np.flatnonzero(table[hashes >> np.uint64(64 - _FILTER_BITS)])
    place = np.searchsorted(wanted, hashes[at])
    place[place == len(wanted)] = 0
    hit = wanted[place] == hashes[at]
    return at[hit], place[hit]


def lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pc.utf8_lower(pc.fill_null(column, "").cast(pa.large_string())))


def item_shingles(texts: list[str | None]) -> list[list[bytes]]:
    """The different shingles of each item, in order of first occurrence."""
    found: list[list[bytes]] = [[] for _ in texts]
    for block in blocks(*lowered(pa.array(texts, pa.string())), PUNCTUATION, SHINGLE - 1):
        w = words(block, PUNCTUATION)
        joined = w.data.tobytes()
        for k, row in enumerate(block.rows):
            a, b = w.first[k], w.first[k + 1]
            if block.whole and 0 < b - a < SHINGLE:
                found[row].append(joined[w.starts[a] : w.ends[b - 1]])
            found[row] += [joined[w.starts[i] : w.ends[i + SHINGLE - 1]] for i in range(a, b - SHINGLE + 1)]
    return [list(dict.fromkeys(x)) for x in found]


def shingle_hashes(shingles: list[bytes]) -> np.ndarray:
    """The same hashes that documents get, for single shingles."""
    values = np.zeros(len(shingles), dtype=np.uint64)
    for at, shingle in enumerate(shingles):
        count = shingle.count(b" ") + 1
        data = np.frombuffer(shingle + b" ", dtype=np.uint8)
        ends = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], ends[:-1] + 1))
        w = Words(data, starts, ends, np.array([0, count]))
        values[at] = combined(w.hashes(), np.array([0]), count)[0]
    return values


def build(texts: list[str], threshold: float) -> Index:
    """The index of one block of different texts."""
    listed = [(t, s) for t, s in zip(texts, item_shingles(texts), strict=True) if s]
    different = list(dict.fromkeys(s for _, own in listed for s in own))
    hashes = dict(zip(different, shingle_hashes(different).tolist(), strict=True))
    # Partitions by size double; the signature serves the largest item of its partition.
    partition = [len(own).bit_length() for _, own in listed]
    largest = {p: max(len(own) for (_, own), q in zip(listed, partition, strict=True) if q == p) for p in set(partition)}
    chosen: dict[int, list[int]] = {}
    for number, ((_, own), p) in enumerate(zip(listed, partition, strict=True)):
        length = int((1 - threshold) * largest[p] + 1e-9) + 1
        for value in sorted(hashes[s] for s in own)[:length]:
            chosen.setdefault(value, []).append(number)
    signature = sorted(chosen)
    return Index(
        [t for t, _ in listed],
        np.array(signature, dtype=np.uint64),
        [chosen[v] for v in signature],
        [{s: hashes[s] for s in own} for _, own in listed],
        sorted({s.count(b" ") + 1 for s in different}),
        threshold,
    )


def candidates(index: Index, texts: pa.Array) -> dict[int, set[int]]:
    """Rows that hold a signature hash, with the items it belongs to. Only hashes are looked at."""
    found: dict[int, set[int]] = {}
    if not len(index.signature):
        return found
    table = sieve(index.signature)
    for block in blocks(*lowered(texts), PUNCTUATION, SHINGLE - 1):
        w = words(block, PUNCTUATION)
        hashes = w.hashes()
        for size in index.sizes:
            heads, text = w.shingles(size)
            for at, place in zip(*present(combined(hashes, heads, size), table, index.signature), strict=True):
                found.setdefault(int(block.rows[text[at]]), set()).update(index.signature_items[place])
    return found


def contained(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, float]]:
    """(row, item number, containment) of the texts of a column that contain an item.

    Shingles are compared as text for candidate rows alone, and only with those of the row's candidates.
    """
    met = candidates(index, texts)
    if not met:
        return
    rows = sorted(met)
    near = set().union(*met.values())
    wanted = np.unique(np.array([h for i in near for h in index.shingles[i].values()], dtype=np.uint64))
    table = sieve(wanted)
    matched: list[set[bytes]] = [set() for _ in rows]
    for block in blocks(*lowered(texts.take(pa.array(rows))), PUNCTUATION, SHINGLE - 1):
        w = words(block, PUNCTUATION)
        hashes = w.hashes()
        # Parts of a long text share words, so short runs may be seen twice: matches are kept as sets.
        for size in index.sizes:
            heads, text = w.shingles(size)
            at, _ = present(combined(hashes, heads, size), table, wanted)
            for head, row in zip(heads[at].tolist(), block.rows[text[at]].tolist(), strict=True):
                matched[row].add(w.data[w.starts[head] : w.ends[head + size - 1]].tobytes())
    for row, own in zip(rows, matched, strict=True):
        for item in sorted(met[row]):
            share = len(own & index.shingles[item].keys()) / len(index.shingles[item])
            if share >= index.threshold:
                yield row, item, share


def item_blocks(items: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> Iterator[list[str]]:
    """Different item texts in blocks of about this many words: the number of blocks follows the benchmark's.

    Copies of an item are one text here, so a text that fills a third of the benchmark fills no block.
    """
    bound_batches(items.sparkSession)
    texts = items.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    size = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    total = texts.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total // block_shingles))
    block = F.pmod(F.xxhash64("text"), F.lit(count))
    for number in range(count):
        yield sorted(r[0] for r in texts.where(block == number).collect())


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, containment) of every item in every document of (doc_id, text)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_text string, containment double"
    result = None
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(build(block, threshold))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                hits = list(contained(index, batch.column("text")))
                rows = pa.array([r for r, _, _ in hits], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        pa.array([index.texts[i] for _, i, _ in hits], pa.string()),
                        pa.array([s for _, _, s in hits], pa.float64()),
                    ],
                    ["doc_id", "item_text", "containment"],
                )

        part = docs.mapInArrow(search, schema)
        result = part if result is None else result.union(part)
    named = items.select("item_id", F.col("text").cast("string").alias("item_text"))
    return result.join(named, "item_text").select("doc_id", "item_id", "containment")


def leaks(index, text: Column) -> Column:
    """Whether a text contains an item of the broadcast index."""

    @F.pandas_udf("boolean")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            flags = np.zeros(len(batch), dtype=bool)
            flags[[row for row, _, _ in contained(index.value, pa.array(batch, pa.string()))]] = True
            yield pd.Series(flags)

    return search(text)


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that contain no item; columns unchanged, no shuffle."""
    name = fresh(docs, "_leak")
    for block in item_blocks(items):
        index = docs.sparkSession.sparkContext.broadcast(build(block, threshold))
        docs = docs.withColumn(name, leaks(index, F.col("text").cast("string"))).where(~F.col(name)).drop(name)
    return docs

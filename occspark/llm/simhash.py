"""SimHash near-duplicates: pivot distance tables discard pairs, Hamming distance verifies the rest.

A text's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of its 3-word shingles.
Two fingerprints link at ``RADIUS`` differing bits or fewer; documents of one connected component
form a group.

Candidates: the 64 bits are cut into five blocks. Up to three differing bits leave at least two
blocks untouched, so each linked pair shares the bits of one of the ten pairs of blocks and meets
in that bucket. Within buckets, each fingerprint's distances to ``PIVOTS`` reference fingerprints
are computed once. The distance to any pivot differs by at most the distance between two
fingerprints (triangle inequality), so pairs whose largest coordinate difference exceeds the radius
go, and the Hamming distance of the survivors is counted. Nothing that links is lost.

Copies meet as one fingerprint. Large buckets are cut into parts (``buckets.bucketed``), and a task
returns a spanning forest of its links rather than the pairs.

Defined cases: a null text is empty; a text without words has fingerprint zero and links like any
other; a text of one or two words has one shingle, the whole sequence. Rows with equal or null
``doc_id`` stay rows of their own in the result; a group whose identifiers are all null has a null
``component_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from occspark.llm.buckets import bucketed, runs, windows
from occspark.llm.graph import components, forest
from occspark.llm.langid import fresh
from occspark.llm.store import bound_batches, stored
from occspark.llm.words import ASCII_LOWER, SPACES, blocks, utf8, words

SHINGLE = 3
SEED = 42
RADIUS = 3
BLOCK_WIDTHS = (13, 13, 13, 13, 12)
PIVOTS = np.random.default_rng(3).integers(0, 1 << 64, 16, dtype=np.uint64)

_LANES = np.uint64(0x0101010101010101)
_CHUNK = 255


def bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of hashes, how many have each of the 64 bits; a byte per bit and 255 hashes at a time."""
    lengths = np.diff(first)
    chunks = -(-lengths // _CHUNK)
    owner = np.repeat(np.arange(len(lengths)), chunks)
    totals = np.zeros((len(lengths), 64), dtype=np.int64)
    if not len(owner):
        return totals
    starts = first[:-1][owner] + _CHUNK * (np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks))
    runs_of = np.flatnonzero(np.diff(owner, prepend=-1))
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        per_byte = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        totals[owner[runs_of], bit::8] = np.add.reduceat(per_byte, runs_of, axis=0)
    return totals


def shingle_bits(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of shingles with each bit set and the number of shingles."""
    offsets, data = utf8(texts)
    counts, shingles = np.zeros((len(texts), 64), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for block in blocks(offsets, data, SPACES, SHINGLE - 1):
        w = words(block, SPACES, ASCII_LOWER)
        heads, text = w.shingles(SHINGLE)
        lows, highs = w.starts[heads], w.ends[heads + SHINGLE - 1]
        if block.whole:
            sizes = np.diff(w.first)
            short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
            lows = np.concatenate((lows, w.starts[w.first[short]]))
            highs = np.concatenate((highs, w.ends[w.first[short] + sizes[short] - 1]))
            text = np.concatenate((text, short))
            order = np.argsort(text, kind="stable")
            lows, highs, text = lows[order], highs[order], text[order]
        joined = w.data.tobytes()
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(lows.tolist(), highs.tolist(), strict=True)),
            dtype=np.uint64,
            count=len(lows),
        )
        first = np.searchsorted(text, np.arange(len(block.rows) + 1))
        counts[block.rows] += bit_counts(hashes, first)
        shingles[block.rows] += np.diff(first)
    return counts, shingles


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    counts, shingles = shingle_bits(texts)
    return np.packbits(2 * counts > shingles[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row of (doc_id, text)."""
    bound_batches(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints_of(batch.column("text")).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        compute, "doc_id long, fp long"
    )


def _bucket_columns() -> list:
    """One bucket per pair of blocks: the table's number above the bits of its two blocks."""
    shifts = np.concatenate(([0], np.cumsum(BLOCK_WIDTHS)))
    keys = []
    for number, (a, b) in enumerate(combinations(range(len(BLOCK_WIDTHS)), 2)):
        low, high = (
            F.shiftrightunsigned("fp", int(shifts[x])).bitwiseAND((1 << BLOCK_WIDTHS[x]) - 1) for x in (a, b)
        )
        keys.append(F.lit(number << 32) + low * (1 << BLOCK_WIDTHS[b]) + high)
    return keys


def near_pairs(
    fp: np.ndarray, group: np.ndarray, part: np.ndarray, within: np.ndarray, radius: int = RADIUS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one group at ``radius`` bits or fewer.

    ``within`` marks groups that compare one part with itself; in others only pairs of different parts count.
    """
    table = np.stack([np.bitwise_count(fp ^ pivot) for pivot in PIVOTS]).astype(np.int16)
    place = group.astype(np.int64) * 256 + table[0]
    order = np.argsort(place, kind="stable")
    place, table, fp, part, within = place[order], table[:, order], fp[order], part[order], within[order]
    high = np.searchsorted(place, place + radius, side="right")
    for i, j in windows(np.arange(len(place)) + 1, high):
        kept = within[i] | (part[i] != part[j])
        i, j = i[kept], j[kept]
        for coordinate in table[1:]:
            close = np.abs(coordinate[i] - coordinate[j]) <= radius
            i, j = i[close], j[close]
        close = np.bitwise_count(fp[i] ^ fp[j]) <= radius
        yield order[i[close]], order[j[close]]


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between different fingerprints that span every group of linked ones. ``nodes`` has distinct ``fp``."""
    rows = nodes.select("fp", F.explode(F.array(*_bucket_columns())).alias("bucket"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, group in runs(batches):
            values = frame["fp"].to_numpy()
            unique, index = np.unique(values, return_inverse=True)
            within = (frame["part_a"] == frame["part_b"]).to_numpy()
            label = np.arange(len(unique))
            for i, j in near_pairs(values.view(np.uint64), group, frame["part"].to_numpy(), within):
                part = forest(label[index[i]], label[index[j]], len(unique))
                label = part[label]
            moved = np.flatnonzero(label != np.arange(len(unique)))
            yield pd.DataFrame({"a": unique[moved], "b": unique[label[moved]]})

    return bucketed(rows, "fp").select("bucket", "part_a", "part_b", "part", "fp").mapInPandas(compare, "a long, b long")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of (doc_id, text); ``root`` is the group's smallest fingerprint."""
    prints = stored(fingerprints(docs))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes)).withColumnRenamed("vertex", "fp")
    rooted = stored(nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return prints.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The contract's columns: fingerprint as 16 hexadecimal digits, component_id."""
    return groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the group's smallest ``doc_id``; columns unchanged.

    Documents are told apart by identifier and fingerprint, so one identifier may lead several groups. Of a group's rows
    with its smallest identifier the one with the smallest fingerprint and then the smallest text is kept; a group with
    null identifiers only is treated likewise.
    """
    key, fp, root, first, first_fp = (fresh(docs, name) for name in ("_id", "_fp", "_root", "_first_id", "_first_fp"))
    # Nulls come last; every group has one leader.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fp")
    leaders = groups(docs).groupBy("root").agg(F.min(order).alias("_first"))
    leaders = leaders.select(F.col("root").alias(root), F.col("_first.doc_id").alias(first), F.col("_first.fp").alias(first_fp))
    base = docs.withColumn(key, F.col("doc_id").cast("long")).withColumn(fp, fingerprints_column(F.col("text")))
    found = base.join(leaders, (F.col(fp) == F.col(first_fp)) & F.col(key).eqNullSafe(F.col(first)))
    # Rows equal in identifier and fingerprint are left to choose from.
    total = ["text", *[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]]
    place = Window.partitionBy(root).orderBy(*total)
    return found.withColumn(key, F.row_number().over(place)).where(F.col(key) == 1).drop(key, fp, root, first, first_fp)


def fingerprints_column(text):
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints_of(pa.array(texts, pa.string())).view(np.int64))

    return compute(text)

"""Audit of how filters interact: which filter removes what, in every order of applying them.

``matrix`` builds a sparse document-term matrix. Each task gathers texts into shards of
``SHARD_BYTES`` and encodes their words by a vocabulary of the shard; the vocabularies of all shards
are sorted by word, which numbers the distinct words of the corpus; each shard's numbers then return
to it and turn its rows into CSR over global word numbers. A word moves once per shard that has it,
never once per occurrence, and texts don't move at all.

``audit`` reads word counts off the matrix: a row's sum is its words, its nonzero entries its
distinct words. Filters and failure conditions: A: under 50 words; B: distinct words under 65 % of
the words; C: capitals A-Z over 5 % of the code points; D: holds any of ``#$%&*|``; E: the same text
has a smaller ``doc_id`` anywhere in the table (SHA-256 stands for the text). Documents are counted by
part, by the set of filters they fail and by label; every order is worked out from these counts.

Defined cases: null texts are empty (and fail A alone, or E as well); words are runs of anything but
ASCII white space; a null source and an empty one are the same part; a null ``doc_id`` is smaller than
none and has no smaller one; rows of one ``doc_id`` and text are not copies of each other by E; a
``doc_id`` with several labels has a label if any row has, and labels of a null one belong to no document; an empty table has no part and no row.
Other columns of the table are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.pandas.types import to_arrow_type

from occspark.llm.shards import SHARD_BYTES, SHARD_ROWS, first_shard, gathered, joined, one_list
from occspark.llm.store import bound_batches, stored

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
_SYMBOLS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
#: Bytes of a text whose words are counted at once.
STRETCH = 1 << 20


def word_counts(data: bytes, stretch: int = STRETCH) -> Counter:
    """How often each word occurs; a long text is counted stretch by stretch, cut at white space."""
    if len(data) <= stretch:
        return Counter(data.split())
    found: Counter = Counter()
    first = 0
    while first < len(data):
        cut = _SPACE.search(data, first + stretch)
        last = cut.start() if cut else len(data)
        found.update(data[first:last].split())
        first = last
    return found


def local_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: its documents, its own vocabulary and CSR arrays over it. A stored table."""
    bound_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    kinds = {
        "doc_id": to_arrow_type(id_type),
        "part": pa.string(),
        "capitals": pa.int64(),
        "symbols": pa.bool_(),
        "points": pa.int64(),
        "digest": pa.binary(),
        "starts": pa.int64(),
        "terms": pa.int32(),
        "counts": pa.int32(),
        "words": pa.string(),
    }
    schema = "shard long, " + f"doc_id array<{id_type.simpleString()}>, " + (
        "part array<string>, capitals array<long>, symbols array<boolean>, points array<long>, digest array<binary>, "
        "starts array<long>, terms array<int>, counts array<int>, words array<string>"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = first_shard()
        for slices in gathered(batches, shard_bytes, shard_rows):
            words: dict[bytes, int] = {}
            starts, terms, counts = array("q", [0]), array("i"), array("i")
            capitals, symbols, digests = [], [], []
            for part in slices:
                for value in part.column("text"):
                    data = value.as_buffer().to_pybytes() if value.is_valid else b""
                    tally = word_counts(data)
                    terms.extend([words.setdefault(w, len(words)) for w in tally])
                    counts.extend(tally.values())
                    starts.append(len(terms))
                    capitals.append(len(data) - len(data.translate(None, _CAPITALS)))
                    symbols.append(_SYMBOLS.search(data) is not None)
                    digests.append(hashlib.sha256(data).digest())
            points = pc.fill_null(pc.utf8_length(joined(slices, "text")), 0)
            columns = {
                "doc_id": joined(slices, "doc_id"),
                "part": joined(slices, "part"),
                "capitals": capitals,
                "symbols": symbols,
                "points": points,
                "digest": digests,
                "starts": np.frombuffer(starts, dtype=np.int64),
                "terms": np.frombuffer(terms, dtype=np.int32) if terms else [],
                "counts": np.frombuffer(counts, dtype=np.int32) if counts else [],
                "words": pa.array(list(words), pa.binary()).cast(pa.string()),
            }
            lists = [one_list(v, kinds[c]) for c, v in columns.items()]
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *lists], ["shard", *columns])
            shard += 1

    texts = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast(StringType()).alias("text"),
    )
    return stored(texts.mapInArrow(count, schema), rows_together=1)


def term_numbers(shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shard, local, term) of every shard's vocabulary, and the ``dictionary`` (term, word): numbers from 0, without gaps."""
    words = shards.select("shard", F.posexplode("words").alias("local", "word"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, now, last = first_shard(), -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column("word")
            other = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            new = np.concatenate(([last is None or word[0].as_py() != last], other))
            ranks = now + np.cumsum(new)
            now, last = int(ranks[-1]), word[-1].as_py()
            first = pa.array(new)
            columns = [
                batch.column("shard"),
                batch.column("local"),
                pa.array(np.full(len(ranks), place)),
                pa.array(ranks),
                pc.if_else(first, word, pa.scalar(None, pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "local", "place", "rank", "word"])

    # Equal words meet in one partition, one row per shard; the sort makes each of them a run.
    ranked = stored(
        words.repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(rank, "shard long, local int, place long, rank long, word string")
    )
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy("place").agg((F.max("rank") + 1).alias("n"))
    # One row per partition of the sort.
    bases = sizes.select("place", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = ranked.join(F.broadcast(bases), "place").withColumn("term", F.col("base") + F.col("rank"))
    return numbered.select("shard", "local", "term"), numbered.where("word IS NOT NULL").select("term", "word")


_DOC = ("doc_id", "part", "capitals", "symbols", "points", "digest")


def matrix(shards: DataFrame, terms: DataFrame) -> DataFrame:
    """CSR shards over global word numbers: per shard its documents' columns, ``starts``, ``terms`` (sorted), ``counts``."""
    kinds = {f.name: f.dataType.simpleString() for f in shards.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("shard", *_DOC, "starts")) + ", terms array<long>, counts array<int>"

    def encode(own: pa.Table, numbers: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table({c: [] for c in ("shard", *_DOC, "starts", "terms", "counts")})
        row = own.combine_chunks()
        values = {c: row.column(c).chunk(0).values for c in ("starts", "terms", "counts")}
        starts, local, counts = (values[c].to_numpy(zero_copy_only=False) for c in ("starts", "terms", "counts"))
        number = np.zeros(numbers.num_rows, dtype=np.int64)
        number[numbers.column("local").to_numpy()] = numbers.column("term").to_numpy()
        term = number[local]
        order = np.lexsort((term, np.repeat(np.arange(len(starts) - 1), np.diff(starts))))
        columns = {c: row.column(c) for c in ("shard", *_DOC, "starts")}
        return pa.table(columns | {"terms": one_list(term[order]), "counts": one_list(counts[order])})

    left = shards.select("shard", *_DOC, "starts", "terms", "counts").groupBy("shard")
    return left.cogroup(terms.groupBy("shard")).applyInArrow(encode, schema)


def row_statistics(csr: DataFrame) -> DataFrame:
    """A row per document: its columns, ``n_words`` (the sum of its row) and ``n_distinct`` (its nonzero entries)."""
    kinds = {f.name: f.dataType.elementType.simpleString() for f in csr.schema if f.name in _DOC}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", n_words long, n_distinct long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                flat = {c: row.column(c).flatten() for c in (*_DOC, "starts", "counts")}
                starts = flat.pop("starts").to_numpy()
                total = np.concatenate(([0], np.cumsum(flat.pop("counts").to_numpy(), dtype=np.int64)))
                sizes = {"n_words": pa.array(total[starts[1:]] - total[starts[:-1]]), "n_distinct": pa.array(np.diff(starts))}
                yield pa.RecordBatch.from_pydict(flat | sizes)

    return csr.select(*_DOC, "starts", "counts").mapInArrow(sums, schema)


def failures(rows: DataFrame) -> DataFrame:
    """(doc_id, part, fails) of every document; ``fails`` has the letters of the filters it fails."""
    rows = stored(rows)
    repeated = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = repeated.where("n > 1").select("digest", "first")
    # A text on a third of all rows is one row here; its documents are narrow rows that adaptive execution splits.
    found = rows.join(repeated, "digest", "left")
    conditions = (
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
        100 * F.col("capitals") > MOST_CAPITALS * F.col("points"),
        F.col("symbols"),
        F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)),
    )
    letters = [F.when(c, f).otherwise("") for f, c in zip(FILTERS, conditions, strict=True)]
    return found.select("doc_id", "part", F.concat(*letters).alias("fails"))


def counted(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and set of failed filters."""
    of_doc = labels.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    named = failed.join(of_doc, failed["doc_id"] == of_doc["_doc"], "left")
    some = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return named.groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), some("good"), some("toxic"))


def every_order(counts: DataFrame) -> DataFrame:
    """The audit's rows from the counts: each of the 120 orders, applied from left to right."""
    orders = " ".join("".join(o) for o in permutations(FILTERS))
    rows = (
        counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), " ")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("own", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumn("earlier", F.substring("filter_order", F.lit(1), F.col("step") - 1))
    )
    fails_own = F.contains("fails", "own")
    before = F.expr("translate(fails, earlier, '')") != F.col("fails")
    removed = fails_own & ~before

    def total(condition, value: str = "n"):
        return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0)).cast("long")

    by_step = rows.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails_own & ~before).alias("kept"),
        total(removed).alias("removed"),
        total(fails_own & before).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "own")).cast("long")
    return by_step.withColumn("shapley", shapley).drop("own")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order and step: what its filter removes, what it would remove again, and what it costs."""
    shards = local_shards(docs)
    terms, _ = term_numbers(shards)
    rows = row_statistics(matrix(shards, terms))
    return every_order(counted(failures(rows), labels))

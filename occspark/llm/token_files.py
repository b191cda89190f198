"""Token counts of flat token files without an index, by a separator scan.

A token file is nothing but 16-bit token identifiers in sequence; each document ends with the
end-of-document identifier. Files are cut into blocks of ``BLOCK_TOKENS``. Each task reads blocks
by byte range and finds the separators with one array comparison. A document may span any number of
blocks: a prefix scan over the blocks of a file carries the number of documents that ended before
and the place behind the last separator, which fixes ordinal, start and length of every document.

``write`` makes such files from a table of texts (the tokenizer's file is a parameter). It returns,
per document, the file and ordinal, which serves to name the counted documents, never to count them.

Defined cases: null and empty texts have 0 tokens; tokens behind a file's last separator are an
unfinished document and returned as such (``ended`` false); an empty file has none; repeated rows are
documents of their own. Texts are tokenised whole; control strings inside them are ordinary text.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from occspark.llm.files import Reader, Upload, make_folder, opened
from occspark.llm.store import bound_batches, shared_folder, stored

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50_256
BLOCK_TOKENS = 1 << 21
TASK_BLOCKS = 8
FILE_TOKENS = 1 << 27
_WIDTH = 2


def encoding(path: str):
    """The tokenizer; a plain function, as it travels to executors that need no copy of this package."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(f"own-{uuid.uuid4().hex}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write token files of (doc_id, text) to ``folder``; returns the stored names: (doc_id, file, ordinal)."""
    make_folder(folder)
    bound_batches(docs.sparkSession)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoding(tokenizer)
        upload, ids = None, []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens = coder.encode_ordinary(text) if text else []
                if upload is None:
                    upload = Upload(folder, ".tokens")
                upload.write(np.array([*tokens, END], dtype="<u2").tobytes())
                ids.append(doc_id)
                if upload.size >= file_tokens * _WIDTH:
                    upload.close()
                    yield _names(ids, upload.name)
                    upload, ids = None, []
        if upload is not None:
            upload.close()
            yield _names(ids, upload.name)

    # Identifiers travel as text: a null beside it turns a long column into doubles in pandas.
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = texts.mapInPandas(encode, "doc_id string, file string, ordinal long")
    return stored(named.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)))


def _names(ids: list, name: str) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "file": name, "ordinal": np.arange(len(ids))})


def token_blocks(spark: SparkSession, folder: str, names: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, first, tokens) of every block; ``names`` has the files. Only sizes are read."""

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = opened(folder)
        for batch in batches:
            found = store.get_file_info([f"{base}/{n}" for n in batch["file"]])
            yield pd.DataFrame({"file": batch["file"], "size": [f.size // _WIDTH for f in found]})

    sized = names.select("file").distinct().mapInPandas(sizes, "file string, size long")
    last = F.floor((F.col("size") - 1) / block_tokens)
    blocks = sized.where("size > 0").select("file", "size", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    first = F.col("block") * block_tokens
    return blocks.select(
        "file", "block", first.alias("first"), F.least(F.lit(block_tokens), F.col("size") - first).alias("tokens")
    )


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """The token files of a folder, as rows."""
    store, base = opened(folder)
    found = store.get_file_info(fs.FileSelector(base))
    return spark.createDataFrame([(f.base_name,) for f in found if f.base_name.endswith(".tokens")], "file string")


def separators(blocks: DataFrame, folder: str, end: int = END) -> DataFrame:
    """Per block one row (file, block, first, tokens, ends) with the places of all separators in the file."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(folder)
        try:
            for batch in batches:
                for at in range(len(batch)):
                    row = batch.iloc[at : at + 1]
                    first, tokens = int(row["first"].iloc[0]), int(row["tokens"].iloc[0])
                    data = reader.read(row["file"].iloc[0], first * _WIDTH, tokens * _WIDTH)
                    ends = first + np.flatnonzero(np.frombuffer(data, dtype="<u2") == end)
                    yield row.assign(ends=[ends])
        finally:
            reader.close()

    # Rows are tiny but name much to read: a given number of tasks, which adaptive execution doesn't merge.
    tasks = max(1, -(-blocks.count() // TASK_BLOCKS))
    dealt = blocks.repartition(tasks, "file", "block")
    return dealt.mapInPandas(search, "file string, block long, first long, tokens long, ends array<long>")


def document_lengths(scanned: DataFrame) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document, from the scanned blocks.

    The scan's window holds a row of four numbers per block of a file: one file of 1 TB has 250,000.
    """
    summary = scanned.select(
        "file",
        "block",
        F.size("ends").alias("n"),
        F.when(F.size("ends") > 0, F.element_at("ends", -1) + 1).alias("behind"),
        (F.col("first") + F.col("tokens")).alias("stop"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("documents"),
        F.coalesce(F.max("behind").over(before), F.lit(0)).alias("open"),
    )
    # A document starts behind the separator before it, in this block or an earlier one.
    starts = F.slice(F.concat(F.array("open"), F.transform("ends", lambda x: x + 1)), F.lit(1), F.size("ends"))
    whole = scanned.join(carried, ["file", "block"]).select(
        "file", "documents", F.posexplode(F.arrays_zip(starts, "ends")).alias("place", "d")
    )
    whole = whole.select(
        "file",
        (F.col("documents") + F.col("place")).alias("ordinal"),
        F.col("d")["0"].alias("start"),
        (F.col("d")["ends"] - F.col("d")["0"]).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    tails = summary.groupBy("file").agg(
        F.sum("n").alias("ordinal"), F.coalesce(F.max("behind"), F.lit(0)).alias("start"), F.max("stop").alias("stop")
    )
    tails = tails.where("stop > start").select(
        "file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return whole.union(tails)


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of every row of documents, counted in the token files made from them."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    names = write(docs, folder, tokenizer)
    scanned = stored(separators(token_blocks(spark, folder, names), folder))
    lengths = document_lengths(scanned)
    return names.join(lengths, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")

"""Rows of stored files picked by their places: one bit per row in place of the row itself.

A place is the number of a row's file block and the row's position in it, as the Parquet reader tells them.
The places of the picked rows become bits of their block, and the files are read again with the blocks beside
them, so nothing but places is shuffled. A block is 512 bytes for ``BLOCK_ROWS`` rows; their number follows
from the files and is checked before they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.operators.rownumber import free_name
from occspark.session import stored_once

_WORD_BITS = 6
_BLOCK_BITS = 12
BLOCK_ROWS = 1 << _BLOCK_BITS
#: 72 MB in a broadcast, for 537 million rows in files of more than one block.
MOST_BLOCKS = 1 << 17
_FILE = "_file"
_BASE = "_base"


def free_place(df: DataFrame) -> str:
    """A name for the place that no column has."""
    return free_name(df, "_place")


def file_blocks(df: DataFrame, most_blocks: int = MOST_BLOCKS) -> DataFrame | None:
    """(file, number of its first block) of the files that ``df`` reads; none if it reads no files, or too many rows."""
    if not df.inputFiles():
        return None
    # A row per file, as in the listing that the reader itself makes.
    last = df.groupBy(F.col("_metadata.file_path").alias(_FILE)).agg(F.max("_metadata.row_index").alias("last"))
    bases, blocks = [], 0
    for file in sorted(last.collect()):
        bases.append((file[_FILE], blocks))
        blocks += (file["last"] >> _BLOCK_BITS) + 1
    if blocks > most_blocks:
        return None
    return df.sparkSession.createDataFrame(bases, f"{_FILE} string, {_BASE} long")


def with_place(df: DataFrame, files: DataFrame, place: str) -> DataFrame:
    """Every row with its place; ``df`` reads the files that ``files`` numbers."""
    file, base = free_name(df, _FILE, place), free_name(df, _BASE, place)
    numbered = files.withColumnsRenamed({_FILE: file, _BASE: base})
    found = df.withColumns({file: F.col("_metadata.file_path"), place: F.col("_metadata.row_index")})
    located = found.join(F.broadcast(numbered), file)
    return located.withColumn(place, F.col(base) * BLOCK_ROWS + F.col(place)).drop(file, base)


def _block(place: Column) -> Column:
    return F.shiftright(place, _BLOCK_BITS)


def _word(place: Column) -> Column:
    return F.shiftright(place, _WORD_BITS).bitwiseAND(F.lit((1 << _BLOCK_BITS - _WORD_BITS) - 1)).cast("int")


def _bit(place: Column) -> Column:
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", one, place.bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).cast("int"))


def place_blocks(places: DataFrame, place: str) -> DataFrame:
    """(block, words) with a bit for every place; blocks without any are absent."""
    at = F.col(place)
    words = places.groupBy(_block(at).alias("block"), _word(at).alias("word")).agg(F.bit_or(_bit(at)).alias("bits"))
    # A block has no more words than a place has word numbers: 64.
    held = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    numbers = F.sequence(F.lit(0), F.lit((1 << _BLOCK_BITS - _WORD_BITS) - 1))
    filled = F.transform(numbers, lambda n: F.coalesce(F.element_at("held", n), F.lit(0).cast("long")))
    return held.select("block", filled.alias("words"))


def marked(rows: DataFrame, places: DataFrame, place: str) -> DataFrame:
    """The rows whose place is among ``places``, without their place."""
    block, words = free_name(rows, "_block"), free_name(rows, "_words")
    blocks = stored_once(place_blocks(places, place)).withColumnsRenamed({"block": block, "words": words})
    at = F.col(place)
    met = rows.withColumn(block, _block(at)).join(F.broadcast(blocks), block)
    is_marked = F.get(words, _word(at)).bitwiseAND(_bit(at)) != 0
    return met.where(is_marked).select(*[f"`{c}`" for c in rows.columns if c != place])

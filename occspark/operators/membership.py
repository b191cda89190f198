"""Membership of a large table's keys in a small one: a Bloom filter drops rows before they are shuffled.

The filter is a table of 64-bit blocks. A key belongs to one block and sets four of its bits there, so
building is one combining aggregate (``bit_or`` per block) and testing is an equi-join to the broadcast
blocks. Its size follows from the counted keys and is checked before it is broadcast; beyond
``MOST_BLOCKS`` the exact join stands alone. What passes is always checked by an exact join, so a false
positive costs a shuffled row and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.operators.rownumber import free_name
from occspark.operators.skew import lookup_join

BITS_PER_KEY = 16
#: 16 bytes each in a broadcast: 64 MB.
MOST_BLOCKS = 1 << 22
_BITS_SET = 4


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    other = F.xxhash64(key, F.lit("bits"))
    bits = [F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_BITS_SET)]
    mask = F.lit(0).cast("long")
    for bit in bits:
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, bits) of a table's keys; nulls are in no filter."""
    rows = keys.where(F.col(key).isNotNull()).select(_block(F.col(key), blocks).alias("block"), _mask(F.col(key)).alias("bits"))
    return rows.groupBy("block").agg(F.bit_or("bits").alias("bits"))


def prefiltered(rows: DataFrame, keys: DataFrame, key: str, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The rows whose key may be among ``keys``: all that are, and few others. Nothing is shuffled."""
    blocks = max(1, -(-keys.count() * BITS_PER_KEY // 64))
    if blocks > most_blocks:
        return rows
    block, bits = free_name(rows, "_block"), free_name(rows, "_bits")
    held = bloom_blocks(keys, key, blocks).withColumnsRenamed({"block": block, "bits": bits})
    mask = _mask(F.col(key))
    met = rows.withColumn(block, _block(F.col(key), blocks)).join(F.broadcast(held), block)
    return met.where(F.col(bits).bitwiseAND(mask) == mask).select(*[f"`{c}`" for c in rows.columns])


def semi_join(small: DataFrame, large_keys: DataFrame, key: str) -> DataFrame:
    """Rows of the small table whose key is in the large one."""
    known = prefiltered(large_keys.select(key), small, key).distinct()
    return lookup_join(small, known, [key], "left_semi")


def anti_join(small: DataFrame, large_keys: DataFrame, key: str) -> DataFrame:
    """Rows of the small table whose key is not in the large one."""
    known = prefiltered(large_keys.select(key), small, key).distinct()
    return lookup_join(small, known, [key], "left_anti")

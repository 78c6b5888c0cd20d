"""Bloom filter as a small table of bitmaps, in DataFrame functions only.

A key belongs to one block of 32768 bits (the size of Spark's bitmap aggregates) and
sets a few bits there, so testing a row is one equi-join with the block table, whose
size is bounded by ``MAX_BLOCKS``, and a few looks into one bitmap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32768            # bits of a bitmap
PROBES = 4               # bits a key sets
BITS_PER_KEY = 12        # about 1 wrong hit in 200 keys
MAX_BLOCKS = 4096        # 16 MB of bitmaps


def blocks_for(keys: int) -> int | None:
    """Blocks that hold so many keys at the usual rate of wrong hits; None where that passes the bound."""
    n = max(1, math.ceil(keys * BITS_PER_KEY / BLOCK))
    return n if n <= MAX_BLOCKS else None


def _block(keys: list[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(blocks))


def _bits(keys: list[Column]) -> list[Column]:
    h = F.xxhash64(F.lit(1), *keys)
    return [F.shiftrightunsigned(h, 15 * i).bitwiseAND(BLOCK - 1) for i in range(PROBES)]


def build(df: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """(block, bitmap) of the keys in ``df``: at most ``blocks`` rows."""
    cols = [F.col(k) for k in keys]
    bits = df.select(_block(cols, blocks).alias("block"), F.explode(F.array(*_bits(cols))).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def may_hold(df: DataFrame, keys: list[str], filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose keys the filter may hold: all that it does, and a few others."""
    cols = [F.col(k) for k in keys]

    def set_(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("__bitmap"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, bit.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1

    blocks_ = F.broadcast(filter_.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap")))
    hit = None
    for bit in _bits(cols):
        hit = set_(bit) if hit is None else hit & set_(bit)
    return df.withColumn("__block", _block(cols, blocks)).join(blocks_, "__block").where(hit).select(*df.columns)

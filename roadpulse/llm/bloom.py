"""Blocked Bloom filter as a table, in SQL expressions.

The filter has blocks of 256 bits, each a row of four 64-bit words, and at most ``MAX_BLOCKS`` rows, so it may be
broadcast whatever the number of keys; more keys only let more false ones through, which an exact join removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 4
MAX_BLOCKS = 1 << 18
BITS_PER_KEY = 16


def _marks(key: Column) -> list[Column]:
    """One bit in each word of a block, from slices of a second hash."""
    h = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter over ``keys`` as rows (block, w0 .. w3), at most ``blocks`` of them; combines before the shuffle."""
    marks = keys.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_marks(F.col(key)))])
    return marks.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(rows: DataFrame, key: str, keys: DataFrame, key_count: int) -> DataFrame:
    """``rows`` whose ``key`` may be among ``keys``: all that are, and few others."""
    blocks = min(MAX_BLOCKS, max(1, -(-key_count * BITS_PER_KEY // (64 * WORDS))))
    table = F.broadcast(bloom_filter(keys, key, blocks))  # at most MAX_BLOCKS rows of 40 bytes
    probed = rows.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks))).join(table, "block")
    for i, m in enumerate(_marks(F.col(key))):
        probed = probed.filter(F.col(f"w{i}").bitwiseAND(m) == m)
    return probed.select(*rows.columns)

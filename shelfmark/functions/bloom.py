"""Bloom filters as rows, so that they can be stored, joined and broadcast like any table.

A filter is a table of blocks of eight words of 32 bits. A key belongs to one block, by the upper half of its hash,
and sets one bit in each word, by the lower half. With KEYS_PER_BLOCK keys a block about one key in a hundred that
was never put in is taken for one that was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_BLOCK = 24
WORDS = tuple(f"w{i}" for i in range(8))
FILTER = "block bigint, " + ", ".join(f"{word} int" for word in WORDS)
#: One odd multiplier below 2^32 a word: upper halves of powers of a number.
_STEPS = tuple(pow(0x9E3779B97F4A7C15, i + 2, 2**64) >> 32 | 1 for i in range(len(WORDS)))


def key_hash(*keys: str | Column, seed: int = 0) -> Column:
    """64 bits of hash over the keys; NULL differs from every value."""
    columns = [F.col(key) if isinstance(key, str) else key for key in keys]
    return F.xxhash64(F.lit(seed), *[part for column in columns for part in (column, column.isNull())])


def blocks_for(n: int) -> int:
    return max(1, -(-n // KEYS_PER_BLOCK))


def block_of(key: Column, blocks: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(key, 32) * F.lit(blocks), 32)


def _masks(key: Column) -> list[Column]:
    low = key.bitwiseAND(F.lit(0x7FFFFFFF))
    bits = [F.shiftright(low * F.lit(step), 27).bitwiseAND(F.lit(31)).cast("int") for step in _STEPS]
    return [F.call_function("shiftleft", F.lit(1), bit) for bit in bits]


def filter_of(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter that holds a table of hashes: ``block`` and its words."""
    masked = keys.select(block_of(F.col(key), blocks).alias("block"), *[m.alias(w) for m, w in zip(_masks(F.col(key)), WORDS)])
    return masked.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def may_hold(rows: DataFrame, key: str, held: DataFrame, blocks: int) -> DataFrame:
    """The rows whose hash the filter may hold. Broadcast ``held`` if its size allows, and nothing is shuffled."""
    probe = rows.withColumn("_block", block_of(F.col(key), blocks))
    masks = zip(_masks(F.col(key)), WORDS, strict=True)
    set_ = reduce(Column.__and__, [F.col(word).bitwiseAND(mask) == mask for mask, word in masks])
    return probe.join(held, (F.col("_block") == F.col("block")) & set_, "left_semi").drop("_block")

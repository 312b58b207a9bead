"""Blocked Bloom filters as small tables.

A filter has 256-bit blocks: one hash of a key picks the block, bits of another set one bit in each of its
eight words, so a probe touches one row. The number of blocks follows from the number of keys and never
exceeds ``MOST_BLOCKS``, which bounds what is broadcast; with more keys than that it lets more rows pass, and
an exact join has to follow in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS = 8
BITS_PER_KEY = 16
MOST_BLOCKS = 1 << 18


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _bit(key: Column, word: int) -> Column:
    """The bit that a key has in a word of its block."""
    picked = F.shiftrightunsigned(F.xxhash64(F.lit(17), key), 5 * word)
    return F.call_function("shiftleft", F.lit(1), picked.bitwiseAND(31).cast("int"))


def blocked_bloom(keys: DataFrame, name: str) -> DataFrame:
    """The filter of the column ``name``: blocks (their number), block, and the words w0 to w7 of each block
    that has a bit set."""
    wanted = F.ceil(F.count("*") * BITS_PER_KEY / (32 * BLOCK_WORDS))
    blocks = keys.agg(F.least(F.greatest(wanted, F.lit(1)), F.lit(MOST_BLOCKS)).alias("blocks"))
    key = F.col(name)
    return (
        keys.select(name)
        .join(F.broadcast(blocks))
        .groupBy("blocks", _block(key, F.col("blocks")).alias("block"))
        .agg(*[F.bit_or(_bit(key, word)).alias(f"w{word}") for word in range(BLOCK_WORDS)])
    )


def may_be_in(rows: DataFrame, name: str, bloom: DataFrame) -> DataFrame:
    """The rows whose column ``name`` has all its bits set: all that are among the keys, and few others."""
    key = F.col(name)
    blocks = bloom.agg(F.max("blocks").alias("__blocks"))
    words = [F.col(f"w{word}").alias(f"__w{word}") for word in range(BLOCK_WORDS)]
    words = bloom.select(F.col("block").alias("__block"), *words)
    probed = rows.join(F.broadcast(blocks)).join(
        F.broadcast(words), F.col("__block") == _block(key, F.col("__blocks"))
    )
    for word in range(BLOCK_WORDS):
        probed = probed.filter(F.col(f"__w{word}").bitwiseAND(_bit(key, word)) != 0)
    return probed.select(*rows.columns)

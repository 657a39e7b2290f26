"""A blocked Bloom filter of column values, made of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A block is four 64-bit words, of which an entry sets two bits in each.
WORDS, BITS_PER_WORD = 4, 2
# With 16 bits an entry about one absent value in a thousand passes.
BITS_PER_ENTRY = 16
# Bound of the filter: 2**17 blocks of 40 bytes are 5 MB, so it can always be
# broadcast. More entries fill the blocks more, and more absent values pass;
# an exact join behind the filter takes them out, and none gets lost.
MAX_BLOCKS = 1 << 17

_BLOCK = "_bloom_block"


def block_count(entries: int) -> int:
    wanted = entries * BITS_PER_ENTRY // (64 * WORDS)
    return min(MAX_BLOCKS, 1 << max(0, wanted - 1).bit_length())


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def masks(key: Column) -> list[Column]:
    """The bits of an entry in each word of its block."""
    second = F.xxhash64(key, F.lit("bits"))
    found = []
    for word in range(WORDS):
        mask = F.lit(0).cast("long")
        for n in range(BITS_PER_WORD):
            shift = 6 * (word * BITS_PER_WORD + n)
            place = F.shiftrightunsigned(second, shift).bitwiseAND(63).cast("int")
            one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
            mask = mask.bitwiseOR(one)
        found.append(mask)
    return found


def blocked_bloom(entries: DataFrame, key: str, blocks: int) -> DataFrame:
    """The blocks in which the values of ``key`` set bits, and these bits."""
    marked = entries.select(
        block_of(F.col(key), blocks).alias(_BLOCK),
        *[m.alias(f"_w{i}") for i, m in enumerate(masks(F.col(key)))],
    )
    return marked.groupBy(_BLOCK).agg(
        *[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)]
    )


def probed(rows: DataFrame, key: Column, bloom: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``_possible``: whether ``key`` may be an entry."""
    names = rows.columns
    joined = rows.withColumn(_BLOCK, block_of(key, blocks)).join(
        F.broadcast(bloom), _BLOCK, "left"
    )
    hit = F.lit(True)
    for i, mask in enumerate(masks(key)):
        hit &= F.col(f"_w{i}").bitwiseAND(mask) == mask
    return joined.select(
        *[F.col(f"`{n}`") for n in names],
        F.coalesce(hit, F.lit(False)).alias("_possible"),
    )

"""Bloom filters over stored ids, as a small table: one bitmap of 4 KB per block of ids.

An id belongs to one block by its hash and sets ``PROBES`` of the block's 32,768 bits. The bitmaps of several appends
are merged by ``or`` when they are read, so a store grows by appending. ``blocks`` is a parameter of the store; about
3,000 ids a block keep the false positives near one in a hundred, and more ids only send more rows to the exact join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a block: the width of Spark's bitmap functions.
BITS = 32_768

#: Bits that an id sets.
PROBES = 5

#: Blocks of a store, for about twelve million ids.
BLOCKS = 4_096

#: Bitmaps that may be broadcast: 32 MB.
BROADCAST_BLOCKS = 8_192


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(blocks))  # as text: an int and a long of equal value are one id


def positions(key: Column) -> Column:
    """The bits of an id, by double hashing; the step is odd, so they differ."""
    text = key.cast("string")
    start, step = F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text).bitwiseOR(F.lit(1).cast("long"))
    low, odd = F.pmod(start, F.lit(BITS)), F.pmod(step, F.lit(BITS))
    return F.array(*[F.pmod(low + odd * i, F.lit(BITS)) for i in range(PROBES)])


def filters(ids: DataFrame, key: str = "id", blocks: int = BLOCKS) -> DataFrame:
    """``DF[block, bits]`` over the ids that are not null; partial bitmaps are merged before and after the shuffle."""
    set_bits = ids.filter(F.col(key).isNotNull()).select(block_of(F.col(key), blocks).alias("block"), F.explode(positions(F.col(key))).alias("bit"))
    return set_bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(parts: DataFrame) -> DataFrame:
    """One bitmap a block from those of all appends."""
    return parts.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def flagged(items: DataFrame, parts: DataFrame, key: str = "id", blocks: int = BLOCKS) -> DataFrame:
    """``items`` with ``_maybe``: false where the id is surely not in the store."""
    one = merged(parts).withColumnRenamed("block", "_block").withColumnRenamed("bits", "_bits")
    one = F.broadcast(one) if blocks <= BROADCAST_BLOCKS else one
    joined = items.withColumn("_block", block_of(F.col(key), blocks)).join(one, "_block", "left")
    every = F.forall(positions(F.col(key)), lambda p: is_set(F.col("_bits"), p))
    return joined.withColumn("_maybe", F.col(key).isNotNull() & F.coalesce(every, F.lit(False))).drop("_block", "_bits")


def outside(items: DataFrame, known: DataFrame, parts: DataFrame | None = None, key: str = "id", blocks: int = BLOCKS) -> DataFrame:
    """Items whose key is not among ``known``; with filters only their positives enter the exact anti join.

    Ids that the filters deny need no shuffle and read nothing of ``known``. A null key is never known. Repeated
    items stay repeated.
    """
    if parts is None:
        return items.join(known.select(key), key, "left_anti")
    both = flagged(items, parts, key, blocks)
    certain = both.filter(~F.col("_maybe")).drop("_maybe")
    asked = both.filter("_maybe").drop("_maybe")
    return certain.unionByName(asked.join(known.select(key), key, "left_anti"))

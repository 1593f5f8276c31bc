"""Sharding by fixed virtual slots, in DataFrame functions only.

A record is hashed into one of thousands of virtual slots and stays there for good. A small table maps slots to
shards; it is kept in versions. Bytes are summed per slot, and rebalancing edits the table: single slots leave
the fullest shard for the emptiest one until no such move narrows their gap. Records never move on their own.

Defined results: null keys share one slot; null texts have no bytes and size 1; repeated rows are rows of their
own; an empty table leaves the first map as it is. Other columns are ignored.
"""
from __future__ import annotations

import bisect
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import shared_folder, staged

SLOTS = 4096
#: Parts of a slot that are numbered apart, so that no slot has to be sorted as a whole.
PARTS = 32


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def map_table(spark: SparkSession, shards: list[int], version: int) -> DataFrame:
    """The map as a table ``virtual_slot, shard, version`` of ``len(shards)`` rows."""
    held = F.split(F.lit(",".join(map(str, shards))), ",")
    rows = spark.range(0, len(shards), 1, 1).select(F.col("id").cast("int").alias("virtual_slot"))
    return rows.select("virtual_slot", F.get(held, F.col("virtual_slot")).cast("int").alias("shard"), F.lit(version).alias("version"))


def save_map(table: DataFrame, folder: str) -> None:
    """Add a version to the stored maps; older versions stay."""
    table.write.mode("append").partitionBy("version").parquet(folder)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    maps = spark.read.parquet(folder)
    wanted = maps.agg(F.max("version")).first()[0] if version is None else version
    return maps.filter(F.col("version") == wanted).select("virtual_slot", "shard", "version")


def edited(shard_of: list[int], weight: list[int], shards: int) -> list[int]:
    """The map after moves from the fullest to the emptiest shard, each the one that best closes their gap."""
    out, load = list(shard_of), [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(out):
        load[shard] += weight[slot]
        bisect.insort(held[shard], (weight[slot], slot))
    while True:
        full, free = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        gap, slots = load[full] - load[free], held[full]
        at = bisect.bisect_left(slots, (gap // 2, -1))
        near = [slots[i] for i in (at - 1, at) if 0 <= i < len(slots) and 0 < slots[i][0] < gap]
        if not near:
            return out
        size, slot = min(near, key=lambda x: (abs(2 * x[0] - gap), x))
        slots.remove((size, slot))
        bisect.insort(held[free], (size, slot))
        load[full], load[free], out[slot] = load[full] - size, load[free] + size, free


def slot_bytes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def rebalance(current: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for these loads; both tables have a row per slot at most, and no more is collected."""
    table = sorted((r["virtual_slot"], r["shard"], r["version"]) for r in current.collect())
    weight = {r["virtual_slot"]: r["bytes"] for r in loads.collect()}
    plan = edited([min(s, shards - 1) for _, s, _ in table], [weight.get(v, 0) for v, _, _ in table], shards)
    return map_table(current.sparkSession, plan, table[0][2] + 1)


def numbered(rows: DataFrame, tie: list[str]) -> DataFrame:
    """``slot``: the place of a row in its shard, from 0 without gaps, found from counts of slot parts."""
    parts = rows.withColumn("part", F.pmod(F.xxhash64(*tie), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("shard", "virtual_slot", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("virtual_slot", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("virtual_slot", "part").orderBy(*tie)
    placed = parts.withColumn("place", F.row_number().over(inside) - 1)
    return placed.join(starts, ["virtual_slot", "part"]).withColumn("slot", F.col("first") + F.col("place")).drop("part", "place", "first")


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8, slots: int = SLOTS) -> tuple[DataFrame, str]:
    """Rows ``doc_id, size, text_crc32, virtual_slot, shard, version, slot`` and the folder of the stored maps."""
    spark, raw = docs.sparkSession, F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = staged(docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        slot_of(F.col(key), slots).alias("virtual_slot"),
    ))
    folder = f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    save_map(map_table(spark, [s % shards for s in range(slots)], 1), folder)
    save_map(rebalance(load_map(spark, folder), slot_bytes(rows), shards), folder)
    placed = rows.join(F.broadcast(load_map(spark, folder)), "virtual_slot")
    return numbered(placed, ["doc_id", "text_crc32", "size"]), folder

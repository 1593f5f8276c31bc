"""Equi-joins that stay balanced when one key holds a large share of the rows.

A key is *hot* when it holds at least a thousandth of all rows, so there are never more than a thousand
hot keys: that is the proven bound that allows their list to be broadcast. Rows of a hot key are spread
over ``salts`` sub-keys, and only the hot rows of the other side are repeated. Every other row takes the
ordinary shuffle join. Nothing is dropped, capped or sampled.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_SHARE = 1000
HOT_FLOOR = 20_000


def hot_keys(sizes: DataFrame, on: list[str], count: str = "_n", floor: int = HOT_FLOOR) -> DataFrame:
    """Keys with at least ``1/HOT_SHARE`` of all rows (and at least ``floor`` rows)."""
    total = sizes.agg(F.coalesce(F.sum(count), F.lit(0)).alias("t")).scalar()
    return sizes.filter((F.col(count) >= floor) & (F.col(count) * HOT_SHARE >= total)).select(*on)


def salted_join(
    rows: DataFrame, other: DataFrame, on: list[str], sizes: DataFrame, row_id: list[str],
    how: str = "inner", count: str = "_n", floor: int = HOT_FLOOR, salts: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``other``; ``sizes`` is ``DF[on, count]`` of the rows per key."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = salts or max(8, partitions)
    hot = F.broadcast(hot_keys(sizes, on, count, floor).withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*row_id), F.lit(spread)).cast("int")).otherwise(0)
    left = rows.join(hot, on, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    right = other.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    keys = on + ["_salt"]
    return left.join(right, keys, how).drop("_salt")


def attach_group(rows: DataFrame, sizes: DataFrame, table: DataFrame, key: str, row_id: str) -> DataFrame:
    """Give every row the values of its group (one table row per key)."""
    return salted_join(rows, table, [key], sizes, [row_id])

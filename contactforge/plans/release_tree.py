"""Releases with a tree of digests, so that comparing two of them reads only the parts that differ.

A release is dealt into buckets by a hash of its key. Every bucket has a digest for the set of its keys and one for each column (two
64-bit hashes of key and cell, merged by exclusive or: independent of order, and of columns that come or go); the root has
the same digests over all buckets. Equal roots end a comparison; otherwise unequal buckets are named by the tree and only their rows,
and of them only the shared columns, are read and joined.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.quality import release_diff

BUCKETS = 256
KEYS = ""  # the name under which the tree holds the set of keys


def _digests(hashes: dict[str, tuple[Column, Column]], n: Column) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("column"), a.alias("a"), b.alias("b"), n.alias("n")) for c, (a, b) in hashes.items()])


def write_release(df: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """Rows below ``path/rows``, digests below ``path/tree``; an existing release is an error. Keys are unique and not null."""
    spark, columns = df.sparkSession, sorted(c for c in df.columns if c != key)
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
    placed.repartition("_bucket").write.mode("errorifexists").partitionBy("_bucket").parquet(f"{path}/rows")
    rows = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    cell = {KEYS: F.lit(""), **{c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns}}
    sealed = [F.bit_xor(F.xxhash64(F.lit(side), F.col(key).cast("string"), v)).alias(f"{side}{k}") for k, v in enumerate(cell.values()) for side in "ab"]
    wide = rows.groupBy("_bucket").agg(*sealed, F.count("*").alias("n"))
    leaves = wide.select("_bucket", F.inline(_digests({c: (F.col(f"a{k}"), F.col(f"b{k}")) for k, c in enumerate(cell)}, F.col("n"))))
    leaves.coalesce(1).write.mode("errorifexists").parquet(f"{path}/tree/buckets")
    above = spark.read.parquet(f"{path}/tree/buckets").groupBy("column").agg(
        *[F.bit_xor(F.xxhash64(F.lit(side), "_bucket", side)).alias(side) for side in "ab"], F.sum("n").alias("n")
    )
    names = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column")) for c in cell])))  # an empty release has a root too
    root = names.join(above, "column", "left").fillna(0, ["a", "b", "n"])
    root.withColumns({"buckets": F.lit(buckets), "schema": F.lit(placed.schema.json())}).coalesce(1).write.mode("errorifexists").parquet(f"{path}/tree/root")


def _root(spark: SparkSession, path: str) -> dict[str, tuple]:
    """A row per column of the release."""
    return {r["column"]: (r["a"], r["b"], r["n"], r["buckets"], r["schema"]) for r in spark.read.parquet(f"{path}/tree/root").collect()}


def _rows(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(_root(spark, path)[KEYS][4]))
    return spark.read.schema(schema).parquet(f"{path}/rows").filter(F.col("_bucket").isin(buckets)).drop("_bucket")


def changed_buckets(spark: SparkSession, current: str, previous: str) -> list[int]:
    """Buckets whose keys or shared columns differ; at most as many as there are buckets."""
    now, then = _root(spark, current), _root(spark, previous)
    if now[KEYS][3] != then[KEYS][3]:
        raise ValueError("the releases have different numbers of buckets")
    shared = sorted(now.keys() & then.keys())
    if all(now[c][:3] == then[c][:3] for c in shared):
        return []

    def side(path: str) -> DataFrame:
        return spark.read.parquet(f"{path}/tree/buckets").filter(F.col("column").isin([*shared, KEYS]))

    digest = F.struct("a", "b", "n")
    joined = side(current).select("_bucket", "column", digest.alias("now")).join(side(previous).select("_bucket", "column", digest.alias("then")), ["_bucket", "column"], "full_outer")
    return sorted(r["_bucket"] for r in joined.filter(~F.col("now").eqNullSafe(F.col("then"))).select("_bucket").distinct().collect())


def release_tree_diff(spark: SparkSession, current: str, previous: str, key: str = "id") -> DataFrame:
    """What ``release_diff`` gives for the two releases, without reading the buckets that are equal."""
    changed = changed_buckets(spark, current, previous)
    cur_n, prev_n = (_root(spark, path)[KEYS][2] for path in (current, previous))
    if not changed:
        return spark.createDataFrame([(prev_n, cur_n, 0, 0, cur_n, 0)], "prev_n long, cur_n long, added long, removed long, common long, changed long")
    part = release_diff(_rows(spark, current, changed), _rows(spark, previous, changed), key)
    return part.select(
        F.lit(prev_n).cast("long").alias("prev_n"), F.lit(cur_n).cast("long").alias("cur_n"), "added", "removed",
        (F.col("common") + F.lit(cur_n) - F.col("cur_n")).alias("common"), "changed",
    )

"""Approximate nearest neighbours by random projections: hash tables with multi-probe.

A table cuts space by ``hashes`` random directions into strips of ``width``; a training row has one bucket in each table, a test
row asks its own bucket and the ``probes`` buckets that it lies nearest to by its distances to the strips' borders. So the
shuffle carries ``tables`` rows for each training row and ``tables * (1 + probes)`` for each test row, whatever the table's length.

Within a bucket distances are exact. What is lost are neighbours that share no asked bucket: measure it with ``recall``. The exact
search (``learning.knn_neighbours``) stays the default everywhere.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .learning import _distances, _matrix, knn_neighbours

#: Rows and queries of one bucket that meet in one call of the kernel; a longer bucket is dealt over several.
BLOCK = 1024
#: Blocks that travel together on average.
BLOCKS_A_GROUP = 16


def _directions(table: int, hashes: int, dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, table])
    return rng.normal(size=(dims, hashes)), rng.random(hashes)


def _steps(hashes: int) -> np.ndarray:
    """All moves by one or two strips next door, as rows over 2 * hashes columns: down in each direction, then up."""
    moves = [(i,) for i in range(2 * hashes)] + [p for p in combinations(range(2 * hashes), 2) if p[1] - p[0] != hashes]
    out = np.zeros((len(moves), 2 * hashes))
    for row, move in enumerate(moves):
        out[row, list(move)] = 1
    return out


def _keys(strips: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit key for each row of strip numbers; two buckets under one key only cost time."""
    weights = np.random.default_rng([7, table]).integers(1, 2**62, strips.shape[-1], dtype=np.int64) | 1
    with np.errstate(over="ignore"):
        return (strips.astype(np.int64) * weights).sum(axis=-1) + np.int64(table)


def buckets(vec: Column, tables: int, hashes: int, width: float, probes: int, seed: int) -> Column:
    """``array<bigint>``: the vector's bucket in every table, and the ``probes`` nearest others of each."""
    steps = _steps(hashes)
    moved = steps[:, hashes:] - steps[:, :hashes]

    @F.pandas_udf("array<bigint>")
    def run(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        matrix = np.stack(vectors.to_numpy()).astype(np.float64)
        out = []
        for table in range(tables):
            a, b = _directions(table, hashes, matrix.shape[1], seed)
            at = matrix @ a / width + b
            strips = np.floor(at)
            out.append(_keys(strips, table)[:, None])
            if probes:
                inside = at - strips
                cost = np.concatenate([inside**2, (1 - inside) ** 2], axis=1) @ steps.T
                best = cost.argsort(axis=1, kind="stable")[:, :probes]
                out.append(_keys(strips[:, None, :] + moved[best], table))
        return pd.Series(list(np.concatenate(out, axis=1)))

    return run(vec)


def _spread(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Both sides with ``_s, _q, _part``: long buckets are dealt over blocks, and blocks over groups of bounded size.

    Sizes of buckets are counted on Spark and joined; nothing of them reaches the driver but the number of blocks.
    """
    ours = train.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("slices"))
    theirs = test.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("asks"))
    shape = ours.join(theirs, "bucket")  # a bucket that only one side knows falls out here
    blocks = shape.agg(F.sum(F.col("slices") * F.col("asks"))).first()[0] or 0
    parts = max(1, -(-blocks // BLOCKS_A_GROUP))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    part = F.pmod(F.xxhash64("bucket", "_s", "_q"), F.lit(parts)).alias("_part")
    left = test.join(shape, "bucket").withColumn("_q", F.pmod(F.xxhash64("id"), "asks")).withColumn("_s", every("slices"))
    right = train.join(shape, "bucket").withColumn("_s", F.pmod(F.xxhash64("tid"), "slices")).withColumn("_q", every("asks"))
    return left.select("bucket", "_s", "_q", "id", "qvec", part), right.select("bucket", "_s", "_q", "tid", "vec", "y", part), parts


def _block_codes(*tables: pa.Table) -> list[np.ndarray]:
    """Equal numbers for equal (bucket, _s, _q) in all tables."""
    keys = np.concatenate([np.stack([t[c].to_numpy() for c in ("bucket", "_s", "_q")], axis=1) for t in tables])
    codes = np.unique(keys, axis=0, return_inverse=True)[1].ravel()
    return np.split(codes, np.cumsum([len(t) for t in tables])[:-1])


def lsh_neighbours(
    train: DataFrame, test: DataFrame, width: float, k: int = 5, leave_one_out: bool = False, tables: int = 8, hashes: int = 6, probes: int = 16, seed: int = 0,
) -> DataFrame:
    """Up to ``k`` near training rows of every test row: ``DF[id, tid, y, dist]``, ties to the smaller training id.

    ``width`` is a distance: some times that of a usual ``k``-th neighbour. Rows with a null vector are left out; vectors are of one length,
    and other columns are ignored. A test row that meets fewer than ``k`` rows has fewer; a row repeated under several ids counts for each
    id. A bucket with a large share of all rows, as of many copies, is dealt over blocks; its pairs are then all compared.
    """
    options = dict(tables=tables, hashes=hashes, width=width, seed=seed)
    known = train.filter("vec IS NOT NULL").select(F.col("id").alias("tid"), "vec", F.col("y").cast("double").alias("y"), F.explode(buckets("vec", probes=0, **options)).alias("bucket"))
    asked = test.filter("vec IS NOT NULL").select("id", F.col("vec").alias("qvec"), F.explode(buckets("vec", probes=probes, **options)).alias("bucket"))
    left, right, parts = _spread(known, asked)
    kinds = {name: df.schema["id"].dataType.simpleString() for name, df in (("id", test), ("tid", train))}
    schema = f"id {kinds['id']}, tid {kinds['tid']}, y double, dist double"

    def near(asks: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("tid")
        ids, tids, ys = (t.combine_chunks() for t in (asks["id"], rows["tid"], rows["y"]))
        found = [pa.table({"id": ids.slice(0, 0), "tid": tids.slice(0, 0), "y": ys.slice(0, 0), "dist": pa.array([], pa.float64())})]
        if not len(asks) or not len(rows):
            return found[0]
        points, centres = _matrix(rows["vec"]), _matrix(asks["qvec"])
        own = pc.fill_null(pc.index_in(ids, value_set=tids), -1).to_numpy() if leave_one_out else None
        ask_codes, row_codes = _block_codes(asks, rows)
        ask_order, row_order = ask_codes.argsort(kind="stable"), row_codes.argsort(kind="stable")
        values, starts = np.unique(ask_codes[ask_order], return_index=True)
        ends = np.append(starts[1:], len(ask_order))
        first = np.searchsorted(row_codes[row_order], values, "left")
        last = np.searchsorted(row_codes[row_order], values, "right")
        for lo, hi, a, b in zip(starts, ends, first, last):
            if a == b:
                continue
            q, r = ask_order[lo:hi], row_order[a:b]
            d = _distances(centres[q], points[r])
            if own is not None:
                # the copies of a repeated training id are all left out
                same = pc.index_in(tids.take(pa.array(r)), value_set=tids).to_numpy()
                d[own[q][:, None] == same[None, :]] = np.inf
            best = d.argsort(axis=1, kind="stable")[:, :k]
            at, flat = np.repeat(np.arange(len(q)), best.shape[1]), best.ravel()
            keep = np.isfinite(d[at, flat])
            at, flat = at[keep], flat[keep]
            found.append(pa.table({"id": ids.take(pa.array(q[at])), "tid": tids.take(pa.array(r[flat])), "y": ys.take(pa.array(r[flat])), "dist": d[at, flat]}))
        return pa.concat_tables(found)

    met = left.groupBy("_part").cogroup(right.groupBy("_part")).applyInArrow(near, schema)
    once = met.groupBy("id", "tid").agg(F.min_by("y", "dist").alias("y"), F.min("dist").alias("dist"))  # met in several tables
    rank = F.row_number().over(Window.partitionBy("id").orderBy("dist", "tid"))
    return once.withColumn("_r", rank).filter(F.col("_r") <= k).drop("_r")


def lsh_knn_score(train: DataFrame, test: DataFrame, width: float, k: int = 5, **options) -> DataFrame:
    """Share of positive labels among the near rows found: ``DF[id, score]``; a test row that met none has a null score."""
    near = lsh_neighbours(train, test, width, k, **options).groupBy("id").agg(F.avg("y").alias("score"))
    return test.select("id").join(near, "id", "left")


def recall(train: DataFrame, test: DataFrame, width: float, k: int = 5, leave_one_out: bool = False, **options) -> DataFrame:
    """``DF[asked, found, recall]``: how many of the exact neighbours of ``test`` the tables find. Give a ``test`` the exact search can bear."""
    exact = knn_neighbours(train, test, k, leave_one_out=leave_one_out).select("id", "tid")
    near = lsh_neighbours(train, test, width, k, leave_one_out, **options).select("id", "tid", F.lit(1).alias("hit"))
    counts = exact.join(near, ["id", "tid"], "left").agg(F.count("*").alias("asked"), F.count("hit").alias("found"))
    return counts.withColumn("recall", F.col("found") / F.col("asked"))

"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one sign bit per dimension. Equal codes are one entry that keeps its ``k`` smallest ids. The
entries are dealt into blocks, which meet the queries in groups; in a block each of the code's segments has an index of its
own, built once for a group. For a query the
segment radii grow one after the other: after segment ``j`` was searched at radius ``r`` every code within
``m * r + j`` is known, and the query is done when its k-th verified distance is not larger. Blocks answer
alone; the best ``k`` of a query's blocks are the answer.

Defined results: order is by distance, then id; a query finds itself if it is among the rows; fewer than ``k``
rows give fewer answers; null vectors are neither found nor asked; null elements count as not positive; rows
with the same id are one entry each per code; a query finds vectors of its own length only, and empty ones are like
null; an empty table gives nothing. Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import staged

SEGMENT_BITS = 16
BLOCK_CODES = 32_768
QUERY_CODES = 16_384
#: Queries of a group that are searched at once, and units of work (a block with a group) of one task at most.
SLICE, TASK_UNITS = 1_024, 64
PAIRS = 2_000_000


def codes(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, dims, code``: the sign bits of every vector, packed to bytes."""
    source = rows.filter(F.size(vector) > 0).select(F.col(key).alias("id"), F.col(vector).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pc.list_value_length(batch.column("vector")).to_numpy()
            for n in np.unique(dims).tolist():
                alike = batch.take(pa.array(np.flatnonzero(dims == n)))
                flat = pc.list_flatten(alike.column("vector")).to_numpy(zero_copy_only=False).astype(np.float64)
                packed = np.packbits((flat > 0).reshape(-1, n), axis=1)
                code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(packed.shape[1]), len(packed), [None, pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([alike.column("id"), pa.array(np.full(len(packed), n, np.int32)), code.cast(pa.binary())], names=["id", "dims", "code"])

    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, dims int, code binary")


class Index:
    """Segment tables over the distinct codes of one block."""

    def __init__(self, packed: np.ndarray):
        self.packed, self.n = packed, len(packed)
        bits = packed.shape[1] * 8
        self.width = [min(SEGMENT_BITS, bits - a) for a in range(0, bits, SEGMENT_BITS)]
        self.order, self.start = [], []
        for values, width in zip(self.segments(packed), self.width):
            order = np.argsort(values, kind="stable")
            self.order.append(order)
            self.start.append(np.searchsorted(values[order], np.arange((1 << width) + 1)))

    def segments(self, packed: np.ndarray) -> list[np.ndarray]:
        step = SEGMENT_BITS // 8
        out = []
        for a in range(0, packed.shape[1], step):
            part = packed[:, a : a + step].astype(np.int64)
            out.append(part @ (256 ** np.arange(part.shape[1] - 1, -1, -1)))
        return out

    def nearest(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the entries (distance, entry) that can be among its k nearest: all up to the k-th distance."""
        parts, m = self.segments(queries), len(self.width)
        found = [np.zeros((0, 2), np.int64) for _ in queries]
        open_ = np.arange(len(queries))
        for radius in range(max(self.width) + 1):
            for j, width in enumerate(self.width):
                if radius > width or not len(open_):
                    continue
                masks = np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)
                rest = []
                for part in np.array_split(open_, max(1, len(open_) * len(masks) // PAIRS)):
                    self._grow(queries, parts[j], part, j, masks, found)
                    for q in part:
                        near = found[q]
                        # every code within this distance is known by now
                        sure = m * radius + j
                        if len(near) < self.n and (len(near) < k or np.partition(near[:, 0], k - 1)[k - 1] > sure):
                            rest.append(q)
                open_ = np.array(rest, np.int64)
        return found

    def _grow(self, queries, values, part, j, masks, found) -> None:
        probe = values[part][:, None] ^ masks[None]
        first, size = self.start[j][probe], self.start[j][probe + 1] - self.start[j][probe]
        owner = np.repeat(np.repeat(part, len(masks)), size.ravel())
        flat = size.ravel()
        inside = np.arange(flat.sum()) - np.repeat(np.cumsum(flat) - flat, flat)
        entry = self.order[j][np.repeat(first.ravel(), flat) + inside]
        distance = np.bitwise_count(self.packed[entry] ^ queries[owner]).sum(1, dtype=np.int64)
        cut = np.searchsorted(owner, part), np.searchsorted(owner, part, side="right")
        for q, a, b in zip(part, *cut):
            if b > a:
                both = np.concatenate([found[q], np.stack([distance[a:b], entry[a:b]], 1)])
                found[q] = np.unique(both, axis=0)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, id, distance``: the ``k`` nearest rows of every query."""
    coded = staged(codes(rows, key, vector))
    asked = staged(codes(queries, key, vector))
    kind = dict(coded.dtypes)["id"]
    # of equal codes no more than k ids can be asked for
    least = Window.partitionBy("dims", "code").orderBy("id")
    entries = coded.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k)
    entries = staged(entries.groupBy("dims", "code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    blocks = max(1, -(-entries.count() // BLOCK_CODES))
    groups = max(1, -(-asked.count() // QUERY_CODES))
    held = entries.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"))
    held = held.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "block", "dims", "code", "ids")
    wanted = asked.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    wanted = wanted.select("group", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "dims", "code", "id")
    # by number, since the few bytes of a block say nothing about its work
    units = blocks * groups
    tasks = max(-(-units // TASK_UNITS), min(units, 4 * rows.sparkSession.sparkContext.defaultParallelism))
    unit = ["group", "block", "dims"]

    def search(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(asked):
            unpack = lambda column: np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)
            index, lists = Index(unpack(entries["code"])), entries["ids"].tolist()
            for start in range(0, len(asked), SLICE):
                part = asked[start : start + SLICE]
                for query, near in zip(part["id"], index.nearest(unpack(part["code"]), k)):
                    out += _best(query, near, lists, k)
        return pd.DataFrame(out, columns=["query_id", "id", "distance"])

    held, wanted = (side.repartition(tasks, *unit).groupBy(*unit) for side in (held, wanted))
    answers = held.cogroup(wanted).applyInPandas(search, f"query_id {kind}, id {kind}, distance int")
    best = Window.partitionBy("query_id").orderBy("distance", "id")
    return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def _best(query, near: np.ndarray, lists: list, k: int) -> list[tuple]:
    """The first ``k`` of a query's entries by distance, then id."""
    rows = []
    for distance, entry in near[np.lexsort((near[:, 1], near[:, 0]))]:
        if len(rows) >= k and distance > rows[k - 1][2]:
            break
        rows += [(query, i, int(distance)) for i in lists[entry]]
        rows.sort(key=lambda r: (r[2], r[1]))
    return rows[:k]

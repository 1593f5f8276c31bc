"""Distance-histogram signatures of small structures."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.descriptors import dense
from . import octree
from .octree import AXES


def struct_signature(
    atoms: DataFrame, limit: float = 10.0, step: float = 0.2, cumulative: bool = True, classes: int = fv.STRUCTURE_CLASSES,
    key: str = "id",
) -> DataFrame:
    """Per entry: unordered class pairs x distance bins, cumulative over distance, as one vector.

    ``atoms`` is ``DF[key, pos, cls, x, y, z]`` with classes ``0..classes-1`` and ``pos`` unique per entry.
    Leaves of the octree meet once, so atoms farther apart than ``limit`` rarely do, and only histograms leave a kernel; a
    bin is closed at its upper edge. An entry without any pair inside the limit has no signature.
    """
    bins = int(round(limit / step))
    width = classes * (classes + 1) // 2 * bins
    placed = atoms.select(key, "pos", "cls", *AXES)
    pairs = octree.leaf_pairs(placed, placed, limit, [key], ["pos", "cls"], ["pos", "cls"], once=True)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column("same").to_numpy(zero_copy_only=False)
            for rows, i, j, d2, left, right in octree.batch_hits(batch, limit):
                (pos_a, a), (pos_b, b) = ([side.field(c).to_numpy(zero_copy_only=False)[at] for c in ("pos", "cls")] for side, at in ((left, i), (right, j)))
                low, high = np.minimum(a, b).astype(np.int64), np.maximum(a, b).astype(np.int64)
                bin_ = np.clip(np.ceil(np.sqrt(d2) / step) - 1, 0, bins - 1).astype(np.int64)
                place = (rows * (width // bins) + low * classes - low * (low - 1) // 2 + high - low) * bins + bin_
                # within one leaf every two atoms are met from both sides
                place, n = np.unique(place[~same[rows] | (pos_a < pos_b)], return_counts=True)
                owner = batch.column(key).take(pa.array(place // width))
                yield pa.RecordBatch.from_arrays([owner, pa.array(place % width // bins, pa.int32()), pa.array(place % bins, pa.int32()), pa.array(n, pa.int64())], names=[key, "_pair", "_bin", "n"])

    kind = placed.schema[key].dataType.simpleString()
    found = octree.bounded(pairs).mapInArrow(histogram, f"`{key}` {kind}, _pair int, _bin int, n long")
    counted = found.groupBy(key, "_pair", "_bin").agg(F.sum("n").alias("n"))
    entry = F.struct((F.col("_pair") * bins + F.col("_bin")).alias("i"), "n")
    vectors = counted.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_s"))
    vectors = vectors.select(key, dense(F.col("_s"), width).alias("_h"))
    if not cumulative:
        return vectors.select(key, F.col("_h").alias("vec"))

    def running(at):
        histogram = F.slice(F.col("_h"), at * bins + 1, F.lit(bins))
        start = F.struct(F.lit(0.0).alias("t"), F.array().cast("array<double>").alias("out"))
        return F.aggregate(
            histogram, start,
            lambda acc, n: F.struct((acc["t"] + n).alias("t"), F.array_append(acc["out"], acc["t"] + n).alias("out")),
            lambda acc: acc["out"],
        )

    pairs_at = F.sequence(F.lit(0), F.lit(width // bins - 1))
    return vectors.select(key, F.flatten(F.transform(pairs_at, running)).alias("vec"))

"""Exact n-gram Jaccard join with signature trees: links at 80 % or more, and their components.

1. Documents with equal shingle sets are one node, the smallest of their ids.
2. Two sets that link share at least ``l`` of their lowest ``n - ceil(0.8 n) + l`` hashes. Only these are shuffled.
   A hash that one node alone has can match nothing; of the rest a node keys all but its ``l' - 1`` most frequent
   ones (``l'`` is the least ``l`` of any partner), which cannot lose a link either. Common passages thus key
   nobody who has text of his own. Nodes that share a key are joined to the smallest of them, a star and no
   pairs; the components of the stars hold every link inside.
3. The nodes of a component are a signature tree: leaves of similar size, nodes with the OR of the token bitmaps
   below them and their range of sizes. A dual traversal drops node pairs whose sizes or largest possible overlap
   rule out a link; the rest is compared exactly unless already connected. Large components are cut into parts
   by bytes, and every pair of parts is a task of its own.
4. The links found are contracted to components again.

Bound: a component of ``b`` bytes takes ``(b / PART_BYTES)^2 / 2`` tasks, since its links are exact.

Defined results: null and wordless texts have an empty set, no link and themselves as component; rows with the
same id are taken as linked; rows with a null id get a null component and link nothing; an empty table gives
none; other columns are ignored. Hashes of 64 bits stand for shingles, digests of 128 bits for sets.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from .common import chunks, give_back, small_batches, small_side, texts_of
from .components import components
from .shingling import shingle_sets

PERCENT = 80
#: Spare share of the set size that a prefix holds beyond what a link needs: l = SPARE * n // 100 + 1.
SPARE = 10
PART_BYTES = 4_000_000
BITMAP_BITS = 2048
LEAF, FAN = 16, 8
CELLS = 1_000_000
#: Text bytes that are cut into shingles at once; each takes about a hundred bytes of arrays.
CHUNK = 250_000


def needed(n: int) -> int:
    """The least overlap of a set of ``n`` with any set that links with it."""
    return -(-PERCENT * n // 100)


def spare(n: int) -> int:
    return SPARE * n // 100 + 1


class Tree:
    """A signature tree over sets that are sorted by size; level 0 holds the sets themselves."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, words = sets, BITMAP_BITS // 64
        bitmap = np.zeros((len(sets), words), np.uint64)
        for row, s in zip(bitmap, sets):
            np.bitwise_or.at(row, (s % np.uint64(words)).astype(np.int64), np.uint64(1) << (s >> np.uint64(8)) % np.uint64(64))
        size = np.array([len(s) for s in sets])
        self.levels = [(bitmap, size, size, size - np.bitwise_count(bitmap).sum(1, dtype=np.int64))]
        while len(self.levels[-1][1]) > 1:
            at = np.arange(0, len(self.levels[-1][1]), LEAF if len(self.levels) == 1 else FAN)
            bits, low, high, clash = self.levels[-1]
            self.levels.append((
                np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(clash, at),
            ))

    def fan(self, level: int) -> int:
        return LEAF if level == 1 else FAN


def possible(a: tuple, b: tuple, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which node pairs can hold a link, by sizes and by the bits they share."""
    (bits_a, low_a, high_a, clash_a), (bits_b, low_b, high_b, clash_b) = a, b
    fits = (100 * high_a[x] >= PERCENT * low_b[y]) & (100 * high_b[y] >= PERCENT * low_a[x])
    x, y = x[fits], y[fits]
    shared = np.bitwise_count(bits_a[x] & bits_b[y]).sum(1, dtype=np.int64) + np.minimum(clash_a[x], clash_b[y])
    out = fits.copy()
    out[fits] = (100 + PERCENT) * np.minimum(shared, np.minimum(high_a[x], high_b[y])) >= PERCENT * (low_a[x] + low_b[y])
    return out


def _pairs_below(x: np.ndarray, y: np.ndarray, fan_x: int, fan_y: int, n_x: int, n_y: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    px = (x[:, None, None] * fan_x + np.arange(fan_x)[None, :, None]).repeat(fan_y, 2).ravel()
    py = (y[:, None, None] * fan_y + np.arange(fan_y)[None, None, :]).repeat(fan_x, 1).ravel()
    ok = (px < n_x) & (py < n_y)
    if same:
        ok &= px <= py
    return px[ok], py[ok]


def connect(left: Tree, right: Tree, label_left: np.ndarray, label_right: np.ndarray) -> None:
    """Dual traversal; sets that link get the same (smaller) label. ``left`` may be ``right`` with the same labels."""
    same = left is right
    stack = [(len(left.levels) - 1, len(right.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        i, j, x, y = stack.pop()
        ok = possible(left.levels[i], right.levels[j], x, y)
        x, y = x[ok], y[ok]
        if not len(x):
            continue
        if i == j == 0:
            _verify(left, right, x, y, label_left, label_right, same)
            continue
        fx, fy = left.fan(i) if i else 1, right.fan(j) if j else 1
        step = max(1, CELLS // (fx * fy * BITMAP_BITS // 64))
        for k in range(0, len(x), step):
            px, py = _pairs_below(x[k : k + step], y[k : k + step], fx, fy, len(left.levels[max(i - 1, 0)][1]), len(right.levels[max(j - 1, 0)][1]), same)
            if max(i - 1, 0) == max(j - 1, 0) == 0:
                apart = label_left[px] != label_right[py]
                px, py = px[apart], py[apart]
            stack.append((max(i - 1, 0), max(j - 1, 0), px, py))


def _verify(left: Tree, right: Tree, x: np.ndarray, y: np.ndarray, label_left: np.ndarray, label_right: np.ndarray, same: bool) -> None:
    while len(x):
        apart = label_left[x] != label_right[y]
        x, y = x[apart], y[apart]
        for k in range(min(len(x), 64)):
            a, b = label_left[x[k]], label_right[y[k]]
            if a == b:
                continue
            s, t = left.sets[x[k]], right.sets[y[k]]
            both = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * both >= PERCENT * (len(s) + len(t) - both):
                low, high = min(a, b), max(a, b)
                label_left[label_left == high] = low
                if not same:
                    label_right[label_right == high] = low
        x, y = x[64:], y[64:]


def linked(ids: list, sets: list[np.ndarray], part: list[int] | None = None) -> list[tuple]:
    """Edges (id, smallest connected id) among the sets; with two parts only links between them are looked for."""
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    rank = {v: r for r, v in enumerate(sorted(set(ids)))}
    named = sorted(rank, key=rank.get)
    groups = [order] if part is None or len(set(part)) == 1 else [[i for i in order if part[i] == p] for p in sorted(set(part))]
    trees = [Tree([sets[i] for i in g]) for g in groups]
    labels = [np.array([rank[ids[i]] for i in g]) for g in groups]
    connect(trees[0], trees[-1], labels[0], labels[-1])
    return [(ids[i], named[r]) for g, ls in zip(groups, labels) for i, r in zip(g, ls) if ids[i] != named[r]]


def sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, n, digest, prefix`` of every row."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            sets = shingle_sets(texts_of(batch, "text"))
            prefixes = [s[: len(s) - needed(len(s)) + spare(len(s))].view(np.int64) if len(s) else s.view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
            ], names=["doc_id", "n", "digest", "prefix"])

    return small_batches(source).mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n long, digest binary, prefix array<long>")


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """Stars ``a, b`` around the smallest node of every key; nodes have ``node, n, prefix``."""
    rows = nodes.select("node", "n", F.explode("prefix").alias("h"))
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = rows.join(often, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("keys"))
    least = F.floor(F.lit(SPARE) * F.ceil(F.lit(PERCENT) * F.col("n") / 100) / 100) + 1
    kept = shared.withColumn("take", (F.size("keys") - least + 1).cast("int")).filter("take > 0")
    keys = staged(kept.select("node", F.explode(F.slice("keys", F.lit(1), F.col("take"))).alias("k")).select("node", "k.h"))
    first = keys.groupBy("h").agg(F.min("node").alias("b"))
    return keys.join(first, "h").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def verified_edges(docs: DataFrame, groups: DataFrame, key: str, text: str) -> DataFrame:
    """Links ``a, b`` inside the candidate components ``node, component, n``: enough of them to connect what links."""
    groups = staged(groups)
    kind = dict(groups.dtypes)["node"]
    held = docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(small_side(groups, groups.count()), "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            sets = shingle_sets(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("component"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "component", "grams"],
            )

    sets = staged(held.select("node", "component", "text").mapInArrow(cut, f"node {kind}, component {kind}, grams binary"))
    sizes = sets.groupBy("component").agg(F.sum(F.octet_length("grams")).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    parts = sizes.select("component", F.ceil(F.col("bytes") / PART_BYTES).cast("int").alias("parts"))
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // PART_BYTES))
    own = sets.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = own.select("component", "node", "grams", "part", every.alias("other")).select(
        "component", "node", "grams", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
    ).withColumn("bucket", F.pmod(F.xxhash64("component", "i", "j"), F.lit(buckets)))

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        edges: list[tuple] = []
        rows = rows.sort_values(["component", "i", "j"])
        columns = (rows[c].tolist() for c in ("component", "i", "j", "node", "grams", "part"))
        for _, group in groupby(zip(*columns), key=lambda r: r[:3]):
            _, _, _, ids, raw, part = zip(*group)
            edges += linked(list(ids), [np.frombuffer(g, np.uint64) for g in raw], list(part))
        give_back()
        return pd.DataFrame(edges, columns=["a", "b"])

    return dealt.groupBy("bucket").applyInPandas(join, f"a {kind}, b {kind}")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    rows = staged(sketch(docs, key, text))
    full = rows.filter("n > 0 and doc_id is not null")
    first = full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows"))
    # the copies are taken out by name, so that the prefixes stay where they are
    copies = staged(full.select("digest", "doc_id").join(first.filter("rows > 1"), "digest").filter("doc_id <> node").select("digest", "doc_id"))
    nodes = full.join(small_side(copies, copies.count()), ["digest", "doc_id"], "left_anti")
    groups = components(candidate_edges(nodes.select(F.col("doc_id").alias("node"), "n", "prefix")))
    links = components(verified_edges(docs, groups, key, text))
    of_set = first.join(links, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id"),
    )
    named = rows.join(of_set, "digest", "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the smallest id of every component, one row for each id; rows without an id stay."""
    rows = jaccard_components(docs, key, text).withColumnRenamed("doc_id", key)
    gone = staged(rows.filter(F.col("component_id") != F.col(key)).select(key))
    again = staged(rows.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").select(key))
    kept = docs.join(small_side(gone, gone.count()), key, "left_anti")
    again = small_side(again, again.count())
    return kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates([key])).select(docs.columns)

"""Quality classifier on supervised subword embeddings.

A text is the set of its words and of the character n-grams inside them, each hashed to one of ``BUCKETS``
learned vectors. The vectors are averaged per document and a softmax layer rates the average. Training is
stochastic gradient descent in numpy on a bounded sample of labelled rows; Spark prepares the sample's counts.
Because the layer is linear, scoring adds up one number per feature.

Bound: about ``rows`` labelled rows are learned from, chosen by a hash of the key.

Defined results: null and empty texts get the score of an average of nothing, which is the layer's bias; labels
that are null are ignored; without labelled rows every score is 0.5; repeated rows are rated each; other
columns are ignored. Characters are lower-cased neither in learning nor in scoring, since capitals tell.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, small_batches, small_side, texts_of

BUCKETS = 1 << 17
DIMENSION = 10
GRAMS = (2, 3)
ROWS = 4000
EPOCHS = 5
RATE = 0.5
SEED = 7
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def features(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature of all texts, and the text it belongs to: words first, then n-grams inside words."""
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    start = np.cumsum([0, *map(len, raw)])
    data = np.concatenate(raw) if raw else np.zeros(0, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    owner = np.repeat(np.arange(len(texts)), np.diff(start))
    # words: sums of a rolling hash between the ends of runs without blanks
    first = ~space
    first[1:] &= space[:-1] | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(first)
    salted = (data.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    salted ^= salted >> np.uint64(29)
    with np.errstate(over="ignore"):
        mixed = np.where(space, np.uint64(0), salted)
        place = _places(begin, len(data)).astype(np.uint64)
        weight = (np.uint64(2) * place + np.uint64(3)) * MULTIPLIER
        word = np.add.reduceat(mixed * weight, begin) if len(begin) else np.zeros(0, np.uint64)
        found, whose = [word], [owner[begin]]
        for n in GRAMS:
            if len(data) < n:
                continue
            inside = np.ones(len(data) - n + 1, bool)
            key = np.full(len(inside), np.uint64(n))
            for k in range(n):
                part = slice(k, len(data) - n + 1 + k)
                inside &= ~space[part]
                key = key * np.uint64(257) + data[part]
            inside &= owner[: len(inside)] == owner[n - 1 :]
            found.append(key[inside])
            whose.append(owner[: len(inside)][inside])
        bucket = [((f * MULTIPLIER) >> np.uint64(40)) % np.uint64(buckets) for f in found]
    return np.concatenate(bucket).astype(np.int64), np.concatenate(whose)


def _places(begin: np.ndarray, size: int) -> np.ndarray:
    """How far each place is behind the last word start (0 before the first)."""
    last = np.zeros(size, np.int64)
    last[begin] = begin
    return np.arange(size) - np.maximum.accumulate(last) if size else last


@dataclass
class Model:
    weight: np.ndarray  # one number per bucket: its vector times the difference of the two output rows
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        bucket, owner = features(texts, len(self.weight))
        total = np.bincount(owner, self.weight[bucket], len(texts))
        count = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        return 1 / (1 + np.exp(-(total / count + self.bias)))


def descend(examples: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Gradient descent over examples (buckets, their counts, label)."""
    draw = np.random.default_rng(SEED)
    vectors = draw.uniform(-1 / DIMENSION, 1 / DIMENSION, (buckets, DIMENSION))
    layer, bias = np.zeros((2, DIMENSION)), np.zeros(2)
    steps, step = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for i in draw.permutation(len(examples)):
            at, count, label = examples[i]
            share = (count / count.sum())[:, None] if len(at) else np.zeros((0, 1))
            mean = (vectors[at] * share).sum(0)
            rated = np.exp(layer @ mean + bias)
            wrong = -rated / rated.sum()
            wrong[label] += 1
            wrong *= rate * (1 - step / steps)
            back = wrong @ layer
            layer += np.outer(wrong, mean)
            bias += wrong
            # the mean's gradient goes to every feature whole, as usual for averaged embeddings
            vectors[at] += back * np.minimum(1, share * len(at))
            step += 1
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = ROWS, buckets: int = BUCKETS) -> Model:
    """Learn from the rows with a text and a label of 0 or 1."""
    fit = labelled.filter(F.col(label).isin(0, 1))
    n = fit.count()
    draw = F.pmod(F.xxhash64(key), F.lit(1_000_000)) / 1_000_000
    source = fit.filter(draw < rows / max(n, 1)).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            bucket, owner = features(texts_of(batch, "text"), buckets)
            key, n = np.unique(owner * buckets + bucket, return_counts=True)
            cut = np.searchsorted(key, np.arange(batch.num_rows + 1) * buckets)
            at, n = (key % buckets).astype("<i4"), n.astype("<i4")
            pieces = [(at[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pieces], pa.binary()), pa.array([p[1] for p in pieces], pa.binary()), batch.column("label")], names=["at", "n", "label"])

    counted = small_batches(source).mapInArrow(count, "at binary, n binary, label int").toArrow()
    examples = [(np.frombuffer(a, "<i4"), np.frombuffer(c, "<i4"), y) for a, c, y in zip(*(counted.column(k).to_pylist() for k in ("at", "n", "label")))]
    # the rows arrive in no fixed order; their content fixes it
    examples.sort(key=lambda e: (len(e[0]), e[0].tobytes()))
    return descend(examples, buckets)


def labelled_documents(docs: DataFrame, labels: DataFrame, learn, key: str = "doc_id") -> DataFrame:
    """Documents joined with their labels, learning rows only."""
    marks = labels.filter(learn).select(key, "quality").dropDuplicates([key])
    return docs.select(key, "text").join(small_side(marks, marks.count()), key)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", cut: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 500_000):
            rated = shared.value.score(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rated), pa.array((rated >= cut).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return small_batches(source).mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, score double, predicted int")

"""Language identification by interpolated Kneser-Ney character models, one for each language.

Texts are lower-cased; every run of other characters is one blank. Characters are folded to ``CHAR_BITS`` bits
(exact for the basic plane below that, a hash beyond), so that an n-gram of four fits one 64-bit key. Spark
counts the n-grams of the learning rows; the model keeps sorted key arrays, per order, with the smoothed
log-probabilities of all languages side by side. A text goes to the language with the lowest cross-entropy per
character. *Rejection* is calibrated on the learning rows: a text is rejected when its best cross-entropy is
further above the language's mean than ``SLACK`` deviations, of which the part within texts shrinks with length.

Bound: about ``rows_per_language`` learning rows of each language are taken, by a hash of the key.

Defined results: texts that are null or hold no letter get ``und``, score 0 and are rejected; ties of the
cross-entropy go to the language that sorts first; learning rows without language or text are ignored; with no
learning row every text is ``und``; repeated rows are rated each; other columns are passed on.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import chunks, small_batches, texts_of

ORDER = 4
CHAR_BITS = 15
DISCOUNT = 0.75
SLACK = 6.0
ROWS_PER_LANGUAGE = 1500
#: Text bytes that are coded at once (a longer text alone), and characters that are rated at once.
CHUNK, RATED = 250_000, 100_000


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts in a row (0 is the blank), the place where each text starts, and its letters.

    Every text starts with a blank; the blanks that end a run of others are dropped.
    """
    lowered = [" " + t.lower() for t in texts]
    point = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    start = np.cumsum([0, *map(len, lowered)])
    letter = letter_table()[point]
    code = np.where(point < (1 << CHAR_BITS), point, (point * np.uint32(2654435761)) >> np.uint32(32 - CHAR_BITS)).astype(np.uint64)
    code[~letter] = 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[start[:-1]] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    letters = np.diff(np.concatenate([[0], np.cumsum(letter)])[start])
    return code[keep], place[start], letters


def grams(code: np.ndarray, start: np.ndarray, order: int) -> np.ndarray:
    """The key of the n-gram that ends at every character; blanks stand before a text."""
    key = code.copy()
    own = np.arange(len(code)) - np.repeat(start[:-1], np.diff(start))
    for back in range(1, order):
        before = np.zeros_like(code)
        before[back:] = code[:-back]
        before[own < back] = 0
        key |= before << np.uint64(CHAR_BITS * back)
    return key


@dataclass
class Model:
    """``keys[n]`` sorted n-gram keys; ``log_p[n]`` their log-probabilities; ``log_back[n]`` the weight of n-grams as contexts."""

    languages: list[str]
    keys: dict[int, np.ndarray]
    log_p: dict[int, np.ndarray]
    log_back: dict[int, np.ndarray]
    floor: np.ndarray
    limits: np.ndarray  # per language: mean, deviation between texts, deviation of a character

    def log_probability(self, key: np.ndarray) -> np.ndarray:
        """Of every character given those before it, per language; ``key`` holds the n-grams that end there."""
        out = np.zeros((len(key), len(self.languages)), np.float32)
        left, extra = np.arange(len(key)), np.zeros((len(key), len(self.languages)), np.float32)
        for n in range(ORDER, 0, -1):
            own = key[left] & np.uint64((1 << CHAR_BITS * n) - 1)
            at, hit = find(self.keys[n], own)
            out[left[hit]] = extra[hit] + self.log_p[n][at[hit]]
            left, extra, own = left[~hit], extra[~hit], own[~hit]
            if not len(left):
                return out
            if n > 1:
                at, seen = find(self.keys[n - 1], own >> np.uint64(CHAR_BITS))
                extra = extra + np.where(seen[:, None], self.log_back[n - 1][at], 0)
        out[left] = extra + self.floor
        return out

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per character and language, characters and letters of each text."""
        code, start, letters = coded(texts)
        key, length = grams(code, start, ORDER), np.diff(start)
        owner = np.repeat(np.arange(len(texts)), length)
        total = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(key), RATED):
            own = owner[a : a + RATED]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[first]] += np.add.reduceat(self.log_probability(key[a : a + RATED]), first, axis=0, dtype=np.float64)
        return -total / length[:, None], length, letters

    def rate(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, probability against the other languages, rejected."""
        if not texts:
            return []
        if not self.languages:
            return [("und", 0.0, True)] * len(texts)
        entropy, length, letters = self.cross_entropy(texts)
        best = entropy.argmin(1)
        low = entropy[np.arange(len(texts)), best]
        share = 1 / np.exp((low[:, None] - entropy) * np.sqrt(length)[:, None]).sum(1)
        mean, between, within = self.limits[best].T
        odd = low > mean + SLACK * np.sqrt(between**2 + within**2 / length)
        return [
            (self.languages[b], float(s), bool(o)) if n else ("und", 0.0, True)
            for b, s, o, n in zip(best, share, odd, letters)
        ]


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), int), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def smoothed(counts: dict[int, tuple[np.ndarray, np.ndarray]], languages: list[str]) -> Model:
    """Kneser-Ney from the counts of the longest n-grams (keys, counts for each language index)."""
    kinds, width = {n: [] for n in range(1, ORDER + 1)}, len(languages)
    shift = np.uint64(CHAR_BITS)
    for i in range(width):
        key, count = counts[i]
        for n in range(ORDER, 0, -1):
            if n < ORDER:  # continuation counts: how many characters stand before
                key, count = np.unique(key & np.uint64((1 << CHAR_BITS * n) - 1), return_counts=True)
            kinds[n].append((key, count.astype(float)))
    keys = {n: np.unique(np.concatenate([k for k, _ in kinds[n]])) for n in kinds}
    p = {n: np.zeros((len(keys[n]), width)) for n in keys}
    back = {n: np.zeros((len(keys[n]), width), np.float32) for n in keys}
    floor = np.zeros(width)
    for i in range(width):
        key, count = kinds[1][i]
        total, unseen = count.sum(), DISCOUNT * len(key) / count.sum()
        floor[i] = unseen / (1 << CHAR_BITS)
        p[1][:, i] = floor[i]
        p[1][np.searchsorted(keys[1], key), i] += (count - DISCOUNT) / total
        for n in range(2, ORDER + 1):
            key, count = kinds[n][i]
            context, at = np.unique(key >> shift, return_inverse=True)
            total = np.bincount(at, count)
            weight = DISCOUNT * np.bincount(at) / total
            back_at, seen = find(keys[n - 1], context)
            back[n - 1][back_at[seen], i] = np.log(weight[seen])
            low_at, _ = find(keys[n - 1], keys[n] & np.uint64((1 << CHAR_BITS * (n - 1)) - 1))
            own_at, own = find(context, keys[n] >> shift)
            p[n][:, i] = np.where(own, weight[own_at], 1) * p[n - 1][low_at, i]
            p[n][np.searchsorted(keys[n], key), i] += (count - DISCOUNT) / total[at]
    return Model(languages, keys, {n: np.log(p[n]).astype(np.float32) for n in p}, back, np.log(floor).astype(np.float32), np.zeros((width, 3)))


def learning_rows(docs: DataFrame, learn: Column, key: str, text: str, lang: str, rows_per_language: int) -> DataFrame:
    """About ``rows_per_language`` learning rows of each language, chosen by a hash of the key."""
    fit = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in fit.groupBy(lang).count().collect()}
    if not sizes:
        return fit.select(F.col(lang).alias("lang"), F.col(text).alias("text")).limit(0)
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, rows_per_language / n))])
    draw = F.pmod(F.xxhash64(key), F.lit(1_000_000)) / 1_000_000
    return fit.filter(draw < F.element_at(share, F.col(lang))).select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def train(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    rows = learning_rows(docs, learn, key, text, lang, rows_per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            names, texts = np.array(batch.column("lang").to_pylist(), object), np.array(texts_of(batch, "text"), object)
            for name in sorted(set(names)):
                code, start, _ = coded(list(texts[names == name]))
                key, n = np.unique(grams(code, start, ORDER), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(key)), pa.array(key.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    sums = small_batches(rows).mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(sums.column("lang").to_pylist(), object)
    key, n = sums.column("gram").to_numpy().view(np.uint64), sums.column("n").to_numpy()
    languages = sorted(set(names))
    if not languages:
        return Model([], {}, {}, {}, np.zeros(0), np.zeros((0, 3)))
    counts = {}
    for i, name in enumerate(languages):
        own = names == name
        order = np.argsort(key[own])
        counts[i] = key[own][order], n[own][order]
    model = smoothed(counts, languages)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            entropy, length, letters = shared.value.cross_entropy(texts_of(batch, "text"))
            place = [shared.value.languages.index(x) for x in batch.column("lang").to_pylist()]
            own = entropy[np.arange(len(place)), place]
            some = letters > 0
            yield pa.RecordBatch.from_arrays([batch.column("lang").filter(pa.array(some)), pa.array(own[some]), pa.array(length[some])], names=["lang", "h", "n"])

    fits = rows.mapInArrow(entropies, "lang string, h double, n long").groupBy("lang").agg(
        (F.sum(F.col("h") * F.col("n")) / F.sum("n")).alias("mean"), F.coalesce(F.stddev("h"), F.lit(1.0)).alias("between"),
    ).collect()
    # a character's own deviation is at most about its mean surprise for texts of this kind
    for r in fits:
        model.limits[languages.index(r["lang"])] = r["mean"], max(r["between"], 0.05), r["mean"]
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``score`` and ``rejected``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    source = docs.drop(*[f.name for f in extra])
    schema = T.StructType(source.schema.fields + extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, CHUNK):
            rated = zip(*shared.value.rate(texts_of(batch, text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, rated)], names=schema.names)

    return small_batches(source).mapInArrow(run, schema)

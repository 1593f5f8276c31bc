"""Token counts by rank-synchronous array merging of a sentencepiece BPE vocabulary.

A text is normalised as the model says and cut into pre-tokens, at places that no piece of the vocabulary
crosses. New pre-tokens of a batch are held as ragged numpy arrays of symbols, one array for each length. In
every round each sequence merges its own pair of lowest rank (the leftmost of equals), all sequences at the same
time, until none has a pair left; the surviving symbols are the tokens. A symbol outside the vocabulary counts
as many tokens as it has bytes, or one where the vocabulary has no byte pieces. Very long pre-tokens merge one
by one from a heap, in the same order.

Defined results: null and empty texts have no tokens; control strings inside texts are ordinary text; repeated
rows are counted each; an empty table gives none; other columns are ignored.
"""
from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, small_batches, texts_of

GAP = "▁"  # how the vocabulary writes a space
UNIT = re.compile(f"{GAP}+[^{GAP}]*|[^{GAP}]+")
CACHE_UNITS = 400_000
LONG_UNIT = 256
CELLS = 1_000_000
NONE = np.iinfo(np.int32).max


class Merger:
    """Counts the tokens of texts for one model file; one for each Python worker."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.vocab_size()
        byte_pieces = any(m.is_byte(i) for i in range(size))
        ids = {m.id_to_piece(i): i for i in range(size) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))}
        if any(GAP in p.lstrip(GAP) for p in ids):
            raise ValueError("the vocabulary has pieces with a space after other characters; pre-tokens cannot be cut")
        rank_of = {s: r for r, s in enumerate(sorted({m.get_score(i) for i in ids.values()}, reverse=True))}
        pairs = sorted((ids[p[:k]], ids[p[k:]], rank_of[m.get_score(i)], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
        self.width = size + 5
        table = np.array(pairs or [(-1, -1, 0, 0)], np.int64)
        self.keys = table[:, 0] * self.width + table[:, 1]
        self.ranks, self.merged = table[:, 2].astype(np.int32), table[:, 3].astype(np.int32)
        # a character outside the vocabulary is a symbol above it, told apart by its number of tokens only
        point = np.arange(0x110000)
        spent = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000) if byte_pieces else np.ones(len(point), int)
        self.symbol = (size + spent).astype(np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.cost = np.ones(self.width + 1, np.int64)
        self.cost[size + 1 :] = [1, 2, 3, 4, 0]  # the last one fills rows up
        self.known: dict[str, int] = {}

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; rank NONE where they do not merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def together(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens of sequences of one length (rows)."""
        out, row = np.zeros(len(symbols), np.int64), np.arange(len(symbols))
        rank, made = self.look_up(symbols[:, :-1], symbols[:, 1:])
        while True:
            width = symbols.shape[1]
            if width == 1:
                out[row] = self.cost[symbols[:, 0]]
                return out
            at = rank.argmin(1)
            live = rank[np.arange(len(rank)), at] != NONE
            if not live.all():
                out[row[~live]] = self.cost[symbols[~live]].sum(1)
                row, symbols, rank, made, at = row[live], symbols[live], rank[live], made[live], at[live]
                if not len(row):
                    return out
            each, place = np.arange(len(row)), np.arange(width - 1)[None]
            new = made[each, at]
            symbols = np.take_along_axis(symbols, place + (place > at[:, None]), 1)
            symbols[each, at] = new
            if width == 2:
                continue
            move = place[:, :-1] + (place[:, :-1] >= at[:, None])
            rank, made = np.take_along_axis(rank, move, 1), np.take_along_axis(made, move, 1)
            for side in (-1, 0):  # the pairs that hold the new symbol
                k = at + side
                ok = (k >= 0) & (k < width - 2)
                i, k = each[ok], k[ok]
                rank[i, k], made[i, k] = self.look_up(symbols[i, k], symbols[i, k + 1])

    def alone(self, symbols: np.ndarray) -> int:
        """Tokens of one very long sequence."""
        held, n = symbols.tolist(), len(symbols)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank, made = (x.tolist() for x in self.look_up(symbols[:-1], symbols[1:]))
        heap = [(r, i, held[i], held[i + 1], m) for i, (r, m) in enumerate(zip(rank, made)) if r != NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if held[i] != a or j < 0 or held[j] != b:
                continue
            held[i], held[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0:
                    r, m = self.look_up(np.array([held[left]]), np.array([held[right]]))
                    if r[0] != NONE:
                        heapq.heappush(heap, (int(r[0]), left, held[left], held[right], int(m[0])))
        return int(self.cost[[s for s in held if s >= 0]].sum())

    def count_units(self, units: list[str]) -> dict[str, int]:
        by_length: dict[int, list[str]] = defaultdict(list)
        for u in units:
            by_length[len(u)].append(u)
        out: dict[str, int] = {}
        for length, same in by_length.items():
            step = max(1, CELLS // length)
            for k in range(0, len(same), step):
                part = same[k : k + step]
                symbols = self.symbol[np.frombuffer("".join(part).encode("utf-32-le"), np.uint32)].reshape(len(part), length)
                counts = self.together(symbols) if length <= LONG_UNIT else [self.alone(s) for s in symbols]
                out.update(zip(part, map(int, counts)))
        return out

    def count(self, texts: list[str]) -> list[int]:
        units = [UNIT.findall(t) for t in self.model.normalize(texts)] if texts else []
        used = set().union(*units)
        if len(self.known) + len(used) > CACHE_UNITS:
            self.known = {u: self.known[u] for u in used & self.known.keys()}
        self.known.update(self.count_units(list(used - self.known.keys())))
        return [sum(map(self.known.__getitem__, u)) for u in units]


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = dict(source.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = merger(path)
        for batch in chunks(batches, "text"):
            counts = pa.array(tool.count(texts_of(batch, "text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), counts], names=["doc_id", "n_bytes", "n_tokens"])

    counted = small_batches(source).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""Word shingles of texts as 64-bit hashes, whole record batches at a time in numpy.

Words are the runs without blanks (0x20, 0x09-0x0D) after A-Z were lower-cased; a shingle has five words, and a
text with fewer words is one shingle. Equal hashes are taken as equal shingles (one accident in 2^64 pairs).
"""
from __future__ import annotations

import numpy as np

SHINGLE = 5
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX
        x = (x ^ (x >> np.uint64(27))) * STEP
        return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts, and where the words of each text start."""
    raw = [t.encode().translate(LOWER) for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = ~space
    first[1:] &= space[:-1]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    last = np.zeros(len(data), np.int64)
    last[begin] = begin
    place = (np.arange(len(data)) - np.maximum.accumulate(last)).astype(np.uint64)
    with np.errstate(over="ignore"):
        weight = mixed(place * STEP + np.uint64(1)) | np.uint64(1)
        value = np.where(space, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * weight)
        words = mixed(np.add.reduceat(value, begin))
    return words, np.searchsorted(begin, np.concatenate([[0], ends]))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words, at = word_hashes(texts)
    with np.errstate(over="ignore"):
        joined = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            joined = joined * MIX + words[k : len(words) - SHINGLE + 1 + k] * STEP if len(joined) else joined
            joined = mixed(joined)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(joined[a : b - SHINGLE + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                h = np.uint64(b - a)
                for w in words[a:b]:
                    h = mixed(np.array([h * MIX + w]))[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out

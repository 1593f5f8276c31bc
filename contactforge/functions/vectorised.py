"""Arrow UDFs that count inside sequences, a whole record batch at a time.

Built-in string functions need one pass (and one new string) per k-mer or class; here a batch's bytes are
viewed in place as one array, so there is no per-row Python and the step stays narrow: sequences are never
exploded or shuffled. Everything derived from the counts is ordinary column arithmetic.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import arrow_udf

from .. import fixed_values as fv

#: Letters and rows that are counted at once: a counter holds some eight arrays of eight bytes a letter.
CHUNK_BYTES, CHUNK_ROWS = 1 << 19, 2048


def code_table(groups) -> np.ndarray:
    """Letter to group number, 0-based; letters outside every group are not expected."""
    table = np.zeros(256, dtype=np.int64)
    for number, letters in enumerate(groups):
        for letter in letters:
            table[ord(letter)] = number
    return table


def _chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, row offsets) of consecutive rows, bounded in rows and (but for one long row) in bytes."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), row + CHUNK_ROWS, len(column))
        part = offsets[row : end + 1]
        yield text[part[0] : part[-1]], part - part[0]
        row = end


def _lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists over its own memory."""
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], values.ravel())


def _kmer_counts(text: np.ndarray, offsets: np.ndarray, table: np.ndarray, base: int, k: int) -> np.ndarray:
    """A row of ``base**k`` counts for each sequence of a chunk."""
    rows, size = len(offsets) - 1, base**k
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    places = max(len(text) - k + 1, 0)
    rank = np.zeros(places, dtype=np.int64)
    codes = table[text]
    for j in range(k):
        rank = rank * base + codes[j : j + places]
    inside = owner[:places] == owner[k - 1 : k - 1 + places]
    return np.bincount((owner[:places] * size + rank)[inside], minlength=rows * size).reshape(rows, size)


def kmer_counter(kinds: list[tuple]):
    """UDF: cleaned sequence to the counts of every ``(groups, k)`` kind, one dense array after the other."""
    tables = [(code_table(groups), len(groups), k) for groups, k in kinds]
    width = sum(base**k for _, base, k in tables)

    @arrow_udf("array<double>")
    def count(column: pa.Array) -> pa.Array:
        counts, done = np.empty((len(column), width)), 0
        for text, offsets in _chunks(column):
            rows, at = len(offsets) - 1, 0
            for table, base, k in tables:
                size = base**k
                counts[done : done + rows, at : at + size] = _kmer_counts(text, offsets, table, base, k)
                at += size
            done += rows
        return _lists(counts)

    return count


def kmer_scorer(kind: tuple, weights: list[float]):
    """UDF: cleaned sequence to the summed weight of its k-mers, added up in the order of ``weights``; null for null and by a null weight."""
    groups, k = kind
    table, base, weight, unknown = code_table(groups), len(groups), np.array(weights, dtype=np.float64), None in weights

    @arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        parts = [np.zeros(0)]
        # a running sum adds one after the other, as a fold over the counts would
        parts += [np.cumsum(_kmer_counts(*chunk, table, base, k) * weight, axis=1)[:, -1] for chunk in _chunks(column)]
        return pa.array(np.concatenate(parts), pa.float64(), mask=column.is_null().to_numpy(zero_copy_only=False) | unknown)

    return score


def charge_bisector():
    """UDF: cleaned sequence to the pH of zero net charge by a fixed number of bisection steps (null or empty: null)."""
    signs = {**dict.fromkeys(fv.POSITIVE_PK, 1.0), **dict.fromkeys(fv.NEGATIVE_PK, -1.0)}
    pks = {**fv.POSITIVE_PK, **fv.NEGATIVE_PK}
    first_pk, last_pk = np.full(256, fv.N_TERMINUS_PK), np.full(256, fv.C_TERMINUS_PK)
    for table, values in ((first_pk, fv.N_TERMINUS_PK_BY_RESIDUE), (last_pk, fv.C_TERMINUS_PK_BY_RESIDUE)):
        for letter, pk in values.items():
            table[ord(letter)] = pk

    def solve(text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of sequences that are not empty."""
        groups = [(1.0, 1.0, first_pk[text[offsets[:-1]]]), (-1.0, 1.0, last_pk[text[offsets[1:] - 1]])]
        for letter, pk in pks.items():
            upto = np.concatenate([[0], np.cumsum(text == ord(letter))])
            groups.append((signs[letter], np.diff(upto[offsets]), pk))
        ph, low, high = (np.full(len(offsets) - 1, x) for x in (fv.PH_START, fv.PH_LOW, fv.PH_HIGH))
        with np.errstate(over="ignore"):
            for _ in range(fv.PH_STEPS):
                charge = np.zeros(len(ph))
                for sign, n, pk in groups:
                    charge += sign * n / (1.0 + np.power(10.0, sign * (ph - pk)))
                up = charge > 0
                low, high = np.where(up, ph, low), np.where(up, high, ph)
                ph = (low + high) / 2
        return ph

    @arrow_udf("double")
    def point(column: pa.Array) -> pa.Array:
        found, done = np.full(len(column), np.nan), 0
        for text, offsets in _chunks(column):
            held = np.flatnonzero(np.diff(offsets))
            if len(held):
                # empty ones take no bytes, so the starts of the others and the end bound what is left
                found[done + held] = solve(text, np.append(offsets[held], offsets[-1]))
            done += len(offsets) - 1
        return pa.array(found, pa.float64(), mask=np.isnan(found))

    return point


def class_profiler():
    """UDF: cleaned sequence to 39 class switches per step, then 195 percent positions of class members."""
    tables = [code_table(groups) for groups in fv.THREE_CLASSES.values()]
    shares = np.array([0.0, 0.25, 0.5, 0.75, 1.0])
    width = len(tables) * (3 + 3 * len(shares))

    @arrow_udf("array<double>")
    def profile(column: pa.Array) -> pa.Array:
        values, done = np.empty((len(column), width)), 0
        for text, offsets in _chunks(column):
            rows, length = len(offsets) - 1, np.diff(offsets)
            owner = np.repeat(np.arange(rows), length)
            inside = owner[:-1] == owner[1:]
            switches, places = [], []
            with np.errstate(divide="ignore", invalid="ignore"):
                for table in tables:
                    cls = table[text]
                    # unordered unlike neighbours: {0,1} -> 1, {0,2} -> 2, {1,2} -> 3
                    step = np.where(cls[:-1] != cls[1:], cls[:-1] + cls[1:], 0)[inside]
                    counted = np.bincount(owner[:-1][inside] * 4 + step, minlength=rows * 4).reshape(rows, 4)
                    switches.append(counted[:, 1:] / (length - 1)[:, None])
                    for member in range(3):
                        at = np.flatnonzero(cls == member)
                        first = np.searchsorted(at, offsets)
                        n = np.diff(first)
                        nth = np.maximum(1, np.floor(shares[None, :] * n[:, None])).astype(np.int64)
                        index = np.minimum(first[:-1, None] + nth - 1, max(len(at) - 1, 0))
                        place = (at[index] if len(at) else np.zeros(index.shape, dtype=np.int64)) - offsets[:-1, None] + 1
                        places.append(np.where(n[:, None] > 0, place / length[:, None] * 100.0, 0.0))
            values[done : done + rows] = np.hstack(switches + places)
            done += rows
        return _lists(values)

    return profile

"""Whitening of embeddings with FEAST contour integration.

An entry ``c`` (as double) becomes the whole number ``floor(1024 * c) + 100000``. Spark adds up the sums, then the
covariance of the centred rows (divisor n), a partial product for every task and one sum for every pair of dimensions.

The leading eigenvalues are found on intervals. *Inertia*: the signs of an LDL' factorisation of the shifted covariance
count the eigenvalues above the shift, so bisection finds intervals that hold few eigenvalues and, together, the wanted
ones. *Contour*: for each interval a circle through its ends is integrated with Gauss-Legendre nodes; every node is one
complex shifted solve against a block of vectors, and the nodes of all intervals are rows of one Spark job. Their sum
projects the block onto the interval's eigenspace. *Rayleigh-Ritz* on the projected block gives eigenpairs, which are
refined by further rounds until their residuals are at rounding level, and the number found inside each interval has to
equal its inertia count; otherwise the block grows and the interval is done again.

What comes to the driver is the covariance, ``dims * (dims + 1) / 2`` numbers, and blocks of ``dims`` rows; no row of the
table does. ``MOST_DIMS`` bounds it.

Defined results: rows whose vector is null, empty, of another length than the longest vector, or holds null or non-finite entries
are dropped; repeated ids and repeated vectors count each; components whose eigenvalue is zero to rounding have no whitened
value and are left out, so constant or single rows give none; equal eigenvalues get an orthonormal basis of their space;
signs make the largest entry of a component positive. A deviation beyond 64 bits is null. An empty table gives none.
Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 1024.0, 100_000
MOST_DIMS = 4096
#: Entries beyond this size count as not finite, so that sums stay exact.
MOST = 2.0**40
#: Eigenvalues an interval holds at most where shifts can part them, quadrature nodes of a half circle, and rounds.
INTERVAL, NODES, ROUNDS = 4, 8, 12
#: Residuals relative to the largest eigenvalue at which a pair counts as found.
ENOUGH = 1e-13
ROWS = 4096


def whole_numbers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the usable vectors of a batch, and their entries as whole numbers."""
    length = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    place = np.flatnonzero(length == dims)
    values = column.take(pa.array(place, pa.int64())).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    fine = (np.abs(values) <= MOST).all(axis=1)  # false for what is not a number
    return place[fine], np.floor(values[fine] * SCALE).astype(np.int64) + SHIFT


def _sums(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Rows and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, np.int64)
        for batch in batches:
            _, x = whole_numbers(batch.column("vector"), dims)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(total, pa.int64())], names=["i", "n", "s"])

    rows = vectors.mapInArrow(run, "i int, n long, s long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas().sort_values("i")
    return (int(rows["n"].iloc[0]), rows["s"].to_numpy(np.int64)) if len(rows) else (0, np.zeros(dims, np.int64))


def _second_moments(vectors: DataFrame, dims: int, image: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of the products of every two columns of ``image(rows)``, which are centred."""
    row, column = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            _, x = whole_numbers(batch.column("vector"), dims)
            for at in range(0, len(x), ROWS):
                z = image(x[at : at + ROWS])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int32()), pa.array(column, pa.int32()), pa.array(total[row, column])], names=["i", "j", "v"])

    found = vectors.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((width, width))
    out[found["i"], found["j"]] = found["v"]
    out[found["j"], found["i"]] = found["v"]
    return out


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """By Sylvester's law: the positive pivots of LDL' (blocks of one or two, largest entry first) of ``matrix - shift``."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        n = len(a)
        p = int(np.abs(np.diag(a)).argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        single = n == 1 or abs(a[p, p]) >= 0.6404 * off[i, j]
        lead = [p] if single else [int(i), int(j)]
        rest = np.setdiff1d(np.arange(n), lead)
        pivot = a[np.ix_(lead, lead)]
        if single:
            above += pivot[0, 0] > 0
            if pivot[0, 0] == 0:
                return above
        else:
            above += 1  # a block of two with so large an entry off its diagonal has one eigenvalue of each sign
        side = a[np.ix_(rest, lead)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return int(above)


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals from the top, ``(low, high, eigenvalues)``, that hold the ``wanted`` largest between them."""
    radius = np.abs(matrix).sum(axis=1).max()
    top, small = radius * (1 + 1e-9), radius * 1e-15 * len(matrix)
    low, high, found = -top, top, len(matrix)
    while high - low > small:  # the highest shift that has enough above it
        middle = (low + high) / 2
        n = eigenvalues_above(matrix, middle)
        if n == wanted:
            low, found = middle, n
            break
        low, high, found = (middle, high, n) if n > wanted else (low, middle, found)
    out, todo = [], [(low, top, found)]
    while todo:
        a, b, n = todo.pop()
        if n <= INTERVAL or b - a <= 4 * small:
            out.append((a, b, n))
            continue
        middle = (a + b) / 2
        upper = eigenvalues_above(matrix, middle)
        upper -= eigenvalues_above(matrix, b) if b < top else 0
        todo += [(x, y, k) for x, y, k in ((a, middle, n - upper), (middle, b, upper)) if k]
    return sorted(out, reverse=True)


def _projected(spark, matrix: np.ndarray, parts: list[tuple[float, float]], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """One contour integration for every interval: a Spark row for each node, a complex solve in each."""
    node, weight = np.polynomial.legendre.leggauss(NODES)
    rows = []
    for k, (low, high) in enumerate(parts):
        middle, radius = (low + high) / 2, (high - low) / 2
        for x, w in zip(node, weight):
            turn = np.exp(1j * np.pi * (x + 1) / 2)
            z, share = middle + radius * turn, w / 2 * radius * turn / 2
            rows.append((k, float(z.real), float(z.imag), float(share.real), float(share.imag)))
    cores = max(1, min(len(rows), spark.sparkContext.defaultParallelism))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples():
                y = np.linalg.solve(complex(r.re, r.im) * np.eye(len(matrix)) - matrix, blocks[r.part].astype(complex))
                # nodes of the lower half circle are the conjugates, so the sum of both is twice the real part
                out.append((r.part, (2 * (complex(r.wre, r.wim) * y).real).tobytes()))
            yield pd.DataFrame(out, columns=["part", "block"])

    nodes = spark.createDataFrame(rows, "part int, re double, im double, wre double, wim double").repartition(cores)
    total = [np.zeros_like(b) for b in blocks]
    for r in sorted(nodes.mapInPandas(solve, "part int, block binary").collect(), key=lambda r: (r["part"], r["block"])):
        total[r["part"]] = total[r["part"]] + np.frombuffer(r["block"]).reshape(blocks[r["part"]].shape)
    return total


def feast(spark, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix in falling order and their vectors as columns."""
    dims, scale = len(matrix), np.abs(matrix).max()
    random = np.random.default_rng(7)
    parts = intervals(matrix, wanted)
    # a little room at both ends: eigenvalues beyond the ends are told apart by their values afterwards
    blocks = [random.standard_normal((dims, min(dims, max(n + 4, 2 * n)))) for _, _, n in parts]
    done: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for turn in range(ROUNDS):
        open_parts = [k for k in range(len(parts)) if k not in done]
        if not open_parts:
            break
        ranges = []
        for k in open_parts:
            low, high, _ = parts[k]
            room = max((high - low) * 0.05, scale * 1e-12)
            ranges.append((low - room, high + room))
        for k, y in zip(open_parts, _projected(spark, matrix, ranges, [blocks[k] for k in open_parts])):
            low, high, n = parts[k]
            q, _ = np.linalg.qr(y)
            small = q.T @ matrix @ q
            value, turnout = np.linalg.eigh((small + small.T) / 2)
            vector = q @ turnout
            inside = np.flatnonzero((value > low) & (value <= high))
            residual = np.linalg.norm(matrix @ vector - vector * value, axis=0)
            if len(inside) == n and (residual[inside] <= ENOUGH * scale * np.sqrt(dims)).all():
                done[k] = value[inside], vector[:, inside]
            elif turn and turn % 4 == 0:
                blocks[k] = np.hstack([vector, random.standard_normal((dims, min(dims - vector.shape[1], n + 4)))])
            else:
                blocks[k] = vector
    missed = [parts[k] for k in range(len(parts)) if k not in done]
    if missed:
        raise ArithmeticError(f"inertia counts were not met on {missed}")
    value, vector = np.concatenate([done[k][0] for k in sorted(done)]), np.hstack([done[k][1] for k in sorted(done)])
    order = np.argsort(-value, kind="stable")[:wanted]
    value, vector = value[order], np.linalg.qr(vector[:, order])[0]
    return value, vector * np.sign(vector[np.abs(vector).argmax(axis=0), range(len(order))])


@dataclass
class Whitening:
    """A fitted transform: rows, sums, leading eigenvalues, their vectors as columns, the trace, and what it leaves of the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def image(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / self.n) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 over the dimensions, exact."""
        far = self.n * x - self.sums
        most = int(np.abs(far).max(initial=0))
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return (far * far).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in far]
        return [v if v < 1 << 63 else None for v in exact]


def _vectors(rows: DataFrame, vector: str, *keep: str) -> DataFrame:
    return rows.select(*keep, F.col(vector).cast("array<double>").alias("vector"))


def fit(rows: DataFrame, components: int = 8, vector: str = "embedding") -> Whitening | None:
    """None where no row is usable or all of them are equal."""
    source = _vectors(rows.filter(F.col(vector).isNotNull()), vector)
    dims = source.agg(F.max(F.size("vector"))).first()[0] or 0
    if dims > MOST_DIMS:
        raise ValueError(f"vectors have {dims} dimensions; the covariance is held whole up to {MOST_DIMS}")
    n, sums = _sums(source, dims) if dims else (0, np.zeros(0, np.int64))
    if not n:
        return None
    mean = sums / n
    covariance = _second_moments(source, dims, lambda x: x - mean, dims) / n
    trace = float(np.trace(covariance))
    if trace <= 0:
        return None
    values, vectors = feast(rows.sparkSession, covariance, min(components, dims))
    real = values > trace * dims * np.finfo(float).eps * 8
    model = Whitening(n, sums, values[real], vectors[:, real], trace)
    k = len(model.values)
    left = _second_moments(source, dims, model.image, k) / n
    model.identity_error = float(np.abs(left - np.eye(k)).max())
    return model


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for every usable vector and component."""
    source = _vectors(rows, vector, F.col(key).alias("vec_id"))
    kind = dict(source.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, x = whole_numbers(batch.column("vector"), dims)
            if not len(place):
                continue
            ids = batch.column("vec_id").take(pa.array(np.repeat(place, k), pa.int64()))
            n = len(ids)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1), len(place)), pa.int32()), pa.array(np.full(n, model.n), pa.int64()),
                pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()), pa.array(model.image(x).reshape(-1)),
                pa.array(np.tile(model.values / model.trace, len(place))), pa.array(np.full(n, model.identity_error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return source.mapInArrow(run, schema)

"""Whitening against a full eigen-decomposition, inertia counts, and awkward tables."""
import math

import numpy as np
import pytest

from contactforge.llm import whitening

SF = "/root/testdata/sf0.001"


def reference(rows, k):
    kept = {i: [float(c) for c in v] for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)}
    x = {i: [math.floor(1024 * c) + 100000 for c in v] for i, v in kept.items()}
    n, sums = len(x), [sum(c) for c in zip(*x.values())]
    m = np.array(list(x.values()), float) - np.array(sums) / n
    value, vector = np.linalg.eigh(m.T @ m / n)
    order = np.argsort(-value)[:k]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    return x, n, sums, value[order], vector[:, order], value.sum(), deviation


@pytest.fixture(scope="module")
def table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    odd = [(-1, None), (-2, [None] + [0.5] * 63), (-3, [float("nan")] * 64), (-4, [float("inf")] + [0.0] * 63), (-5, [])]
    return rows + odd, spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, component string")


def test_equals_a_full_decomposition(table):
    rows, frame = table
    x, n, sums, value, vector, trace, deviation = reference(rows, 8)
    out = whitening.whiten(frame, whitening.fit(frame, 8)).toPandas()
    assert len(out) == 8 * n and set(out["vec_id"]) == set(x) and (out["n"] == n).all()
    assert all(deviation[i] == d for i, d in zip(out["vec_id"], out["deviation"]))
    ids = sorted(x)
    own = out.sort_values(["vec_id", "component"])["whitened"].to_numpy().reshape(n, 8)
    expected = (np.array([x[i] for i in ids]) - np.array(sums) / n) @ vector / np.sqrt(value)
    sign = np.sign((own * expected).sum(axis=0))
    assert np.abs(own - expected * sign).max() < 1e-7
    share = out.groupby("component")["explained"].first().to_numpy()
    assert np.abs(share / (value / trace) - 1).max() < 1e-12 and (np.diff(share) <= 0).all()
    error = np.abs(own.T @ own / n - np.eye(8)).max()
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9 and error < 1e-9


@pytest.mark.parametrize("matrix", [
    np.diag([5.0, 5, 5, 5, 3, 3, 1, 0, 0, 0]), np.eye(12), np.diag([1e9, 1e9, 1.0, 1.0, 1e-3]),
    (lambda a: a @ a.T)(np.random.default_rng(1).standard_normal((40, 10))), (lambda a: a @ a.T)(np.random.default_rng(2).standard_normal((60, 200))),
    np.array([[2.0, 1.0], [1.0, 2.0]]), np.array([[4.0]]),
], ids=["equal", "identity", "spread", "low rank", "dense", "two", "one"])
def test_contours_find_the_leading_pairs(spark, matrix):
    wanted = min(8, len(matrix))
    value, vector = whitening.feast(spark, matrix, wanted)
    scale = np.abs(matrix).max()
    assert np.abs(value - np.linalg.eigvalsh(matrix)[::-1][:wanted]).max() < 1e-11 * scale
    assert np.abs(vector.T @ vector - np.eye(wanted)).max() < 1e-12 and np.abs(matrix @ vector - vector * value).max() < 1e-10 * scale


def test_inertia_counts():
    random = np.random.default_rng(3)
    for size in (1, 2, 7, 30):
        a = random.standard_normal((size, size))
        a = a + a.T
        for shift in random.standard_normal(10):
            assert whitening.eigenvalues_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert whitening.eigenvalues_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_intervals_hold_what_they_say():
    a = np.random.default_rng(4).standard_normal((50, 50))
    a, value = a @ a.T, np.linalg.eigvalsh(a @ a.T)
    parts = whitening.intervals(a, 9)
    assert sum(n for _, _, n in parts) == 9 and all(((value > low) & (value <= high)).sum() == n <= whitening.INTERVAL for low, high, n in parts)


def test_tables_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5):
        frame = spark.createDataFrame(rows, schema)
        assert whitening.whiten(frame, whitening.fit(frame)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)] + [(8, [8.0, 16.0, 1.0])], schema)
    out = whitening.whiten(line, whitening.fit(line)).collect()
    assert len(out) == 10 and {r["component"] for r in out} == {1} and abs(out[0]["explained"] - 1) < 1e-12


def test_deviations_are_exact_beyond_64_bits():
    model = whitening.Whitening(3, np.array([0]), np.ones(1), np.ones((1, 1)), 1.0)
    assert model.deviations(np.array([[5], [2**31], [2**28]])) == [225, None, 9 << 56]


def test_wide_vectors_are_refused(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_DIMS", 2)
    with pytest.raises(ValueError):
        whitening.fit(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>"))

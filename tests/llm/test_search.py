import numpy as np
import pytest

from contactforge.llm import hamming_search


def brute(rows, asked, k):
    code = {i: np.array([x is not None and x > 0 for x in v]) for i, v in rows}
    return {q: [(int((code[q] != c).sum()), i) for i, c in code.items()] for q in asked}


@pytest.mark.parametrize("kind", ["random", "copies"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(hamming_search, "BLOCK_CODES", 100)
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(400, 40))
    if kind == "copies":
        vectors[50:300] = vectors[7]
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(vectors)]
    rows[3] = (3, [None] + rows[3][1][1:], "x")
    frame = spark.createDataFrame(rows + [(999, None, "x")], "vec_id long, embedding array<double>, rank string")
    asked = frame.filter("vec_id % 20 = 0")
    got = {}
    for r in hamming_search.top_k(frame, asked, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["id"]))
    want = brute([r[:2] for r in rows], range(0, 400, 20), 7)
    assert got == {q: sorted(v)[:7] for q, v in want.items()}


def test_few_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, -1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert hamming_search.top_k(frame, frame.filter("vec_id = 1"), 10).count() == 3
    assert hamming_search.top_k(frame.limit(0), frame, 10).count() == 0
    assert hamming_search.top_k(frame, frame.limit(0), 10).count() == 0


def test_lengths_do_not_mix(spark):
    rows = [(1, [1.0, -1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0, 0.5]), (4, []), (5, None), (6, [None, -1.0, float("nan")]), (7, [0.5] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"], r.id, r.distance) for r in hamming_search.top_k(frame, frame, 10).collect()}
    assert got == {(1, 1, 1, 0), (1, 2, 2, 1), (2, 1, 2, 0), (2, 2, 1, 1), (3, 1, 3, 0), (3, 2, 6, 3), (6, 1, 6, 0), (6, 2, 3, 3), (7, 1, 7, 0)}


def test_hot_code_and_wide_vectors_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(hamming_search, "BLOCK_CODES", 64)
    monkeypatch.setattr(hamming_search, "QUERY_CODES", 32)
    monkeypatch.setattr(hamming_search, "SLICE", 5)
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(900, 520))
    vectors[100:400] = vectors[0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = hamming_search.top_k(frame, frame.filter("vec_id % 10 = 0"), 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2  # not coalesced, and no exchange above them but the one by query
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.id))
    bits = vectors > 0
    for q in range(0, 900, 10):
        d = (bits != bits[q]).sum(axis=1)
        assert got[q] == sorted(zip(d.tolist(), range(900)))[:5]

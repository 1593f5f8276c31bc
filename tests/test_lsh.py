"""Random-projection tables against the exact neighbours."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from contactforge.operators import learning, lsh

SCHEMA = "id long, vec array<double>, y double"


@pytest.fixture(scope="module")
def families(spark):
    """6,000 vectors of 32 numbers around 300 centres of unequal weight."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(300, 32))
    home = np.minimum(rng.geometric(0.01, 6000) - 1, 299)
    points = centres[home] + rng.normal(size=(6000, 32)) * 0.08
    rows = [(i, p.tolist(), float(h % 2)) for i, (p, h) in enumerate(zip(points, home))]
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_recall_and_work(spark, families):
    asked = families.filter("id % 20 = 0")
    got = lsh.recall(families, asked, 2.0, leave_one_out=True).first()
    assert got.asked == 1500 and got.recall >= 0.9, got
    # the tables look at a small share of all pairs
    keys = dict(tables=8, hashes=6, width=2.0, seed=0)
    known = families.select("id", F.explode(lsh.buckets("vec", probes=0, **keys)).alias("b"))
    pairs = asked.select(F.explode(lsh.buckets("vec", probes=16, **keys)).alias("b")).join(known, "b").count()
    assert pairs < 0.5 * 6000 * 300


def test_what_is_found_is_exact(spark, families):
    near = lsh.lsh_neighbours(families, families.filter("id < 50"), 2.0, k=3)
    wide = near.join(families.select("id", F.col("vec").alias("a")), "id").join(families.select(F.col("id").alias("tid"), F.col("vec").alias("b"), F.col("y").alias("z")), "tid")
    for r in wide.collect():
        assert abs(np.linalg.norm(np.array(r.a) - np.array(r.b)) - r.dist) < 1e-9 and r.y == r.z
    assert near.filter("id = tid AND dist = 0").count() == 50


def test_one_table_with_one_strip_is_the_exact_search(spark, families):
    some = families.filter("id < 300")
    got = {tuple(r) for r in lsh.lsh_neighbours(some, some, 1e9, 4, True, tables=1, hashes=1, probes=2).select("id", "tid").collect()}
    assert got == {tuple(r) for r in learning.knn_neighbours(some, some, 4, leave_one_out=True).select("id", "tid").collect()}


def test_many_copies_are_dealt_over_blocks(spark, monkeypatch):
    rows = spark.range(3000).select("id", F.expr("array(1d, 2d, if(id % 3 = 0, 3d, 0d))").alias("vec"), (F.col("id") % 2).cast("double").alias("y"))
    keys = dict(tables=2, hashes=3, width=1.0, seed=0)
    known = rows.select(F.col("id").alias("tid"), "vec", "y", F.explode(lsh.buckets("vec", probes=0, **keys)).alias("bucket"))
    asked = rows.select("id", F.col("vec").alias("qvec"), F.explode(lsh.buckets("vec", probes=0, **keys)).alias("bucket"))
    left, right, parts = lsh._spread(known, asked)
    assert left.groupBy("bucket", "_s", "_q").count().agg(F.max("count")).first()[0] < 1.3 * lsh.BLOCK
    assert right.groupBy("bucket", "_s", "_q").count().agg(F.max("count")).first()[0] < 1.3 * lsh.BLOCK
    got = lsh.lsh_neighbours(rows, rows.filter("id < 9"), 1.0, 2, True, tables=2, hashes=3, probes=0)
    want = {(i, t) for i in range(9) for t in [j for j in range(12) if j != i and (j % 3 == 0) == (i % 3 == 0)][:2]}
    assert {(r.id, r.tid) for r in got.collect()} == want


def test_edges(spark, frame):
    rows = frame([(1, [0.0, 0.0], 1.0), (1, [0.0, 0.0], 1.0), (2, None, 1.0), (3, [0.0, 0.0], 0.0), (4, [1e6, 1e6], 0.0)], SCHEMA).withColumn("bucket", F.lit(5)).withColumn("tid", F.lit("x"))
    got = {(r.id, r.tid) for r in lsh.lsh_neighbours(rows, rows, 1.0, 5, True, tables=2, hashes=2, probes=3).collect()}
    assert got == {(1, 3), (3, 1)}
    scores = {r.id: r.score for r in lsh.lsh_knn_score(rows, rows, 1.0, leave_one_out=True).collect()}
    assert scores == {1: 0.0, 2: None, 3: 1.0, 4: None}
    none = rows.limit(0)
    assert lsh.lsh_neighbours(none, rows, 1.0).count() == 0 and lsh.lsh_neighbours(rows, none, 1.0).count() == 0

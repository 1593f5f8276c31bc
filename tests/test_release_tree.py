import pytest
from pyspark.sql import functions as F

from contactforge.operators import quality
from contactforge.plans import release_tree

SCHEMA = "id string, name string, n int"


def release(spark, path, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    release_tree.write_release(frame, str(path), **options)
    return frame, str(path)


def test_trees_give_what_rows_give(spark, tmp_path):
    base = [(f"e{i}", f"n{i % 7}", i) for i in range(500)]
    old, a = release(spark, tmp_path / "a", base)
    edits = [(k, "x" if k == "e3" else v, None if k == "e4" else n) for k, v, n in base if k not in ("e9", "e10")] + [("new", None, 1)]
    new, b = release(spark, tmp_path / "b", edits)
    assert release_tree.release_tree_diff(spark, b, a).collect() == quality.release_diff(new, old).collect()
    assert 0 < len(release_tree.changed_buckets(spark, b, a)) <= 5


def test_an_unchanged_release_reads_digests_only(spark, tmp_path, monkeypatch):
    rows = [(f"e{i}", f"n{i}", i) for i in range(200)]
    _, a = release(spark, tmp_path / "a", rows)
    _, b = release(spark, tmp_path / "b", list(reversed(rows)))
    read = []
    parquet = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, **o: read.extend(paths) or parquet(self, *paths, **o))
    assert tuple(release_tree.release_tree_diff(spark, b, a).first()) == (200, 200, 0, 0, 200, 0)
    assert read and all(p.endswith("/tree/root") for p in read)


def test_only_differing_buckets_are_read(spark, tmp_path):
    rows = [(f"e{i}", f"n{i}", i) for i in range(2000)]
    _, a = release(spark, tmp_path / "a", rows)
    _, b = release(spark, tmp_path / "b", [(k, v, n + (k == "e77")) for k, v, n in rows])
    changed = release_tree.changed_buckets(spark, b, a)
    assert len(changed) == 1 and len(release_tree._rows(spark, b, changed).inputFiles()) == len(release_tree._rows(spark, b, list(range(256))).inputFiles())
    plan = release_tree._rows(spark, b, changed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and release_tree._rows(spark, b, changed).count() < 40
    assert tuple(release_tree.release_tree_diff(spark, b, a).first()) == (2000, 2000, 0, 0, 2000, 1)


def test_columns_that_come_or_go_and_empty_releases(spark, tmp_path):
    rows = [(f"e{i}", f"n{i}", i) for i in range(50)]
    old, a = release(spark, tmp_path / "a", rows)
    wider, b = release(spark, tmp_path / "b", old.withColumn("extra", F.lit("x")).drop("n"))
    assert tuple(release_tree.release_tree_diff(spark, b, a).first()) == (50, 50, 0, 0, 50, 0)
    _, none = release(spark, tmp_path / "none", old.limit(0))
    _, nothing = release(spark, tmp_path / "nothing", old.limit(0))
    assert tuple(release_tree.release_tree_diff(spark, none, nothing).first()) == (0, 0, 0, 0, 0, 0)
    assert tuple(release_tree.release_tree_diff(spark, a, none).first()) == (0, 50, 50, 0, 0, 0)


def test_different_bucket_numbers_are_refused(spark, tmp_path):
    _, a = release(spark, tmp_path / "a", [("e", "n", 1)])
    _, b = release(spark, tmp_path / "b", [("e", "n", 1)], buckets=8)
    with pytest.raises(ValueError):
        release_tree.release_tree_diff(spark, b, a)

"""Filters beside stored ids: equal rows, few false positives, known ids alone reach the exact join."""
from __future__ import annotations

from pyspark.sql import functions as F

from contactforge.operators import bloom, membership
from contactforge.streaming import incremental


def test_no_known_id_is_denied_and_few_others_pass(spark):
    known = spark.range(60_000).withColumn("extra", F.lit("x"))
    parts = bloom.filters(known, blocks=20).unionByName(bloom.filters(spark.range(50_000, 60_000), blocks=20))
    items = spark.range(0, 160_000).select(F.col("id").cast("int").alias("id"))  # another width of integer
    seen = bloom.flagged(items, parts, blocks=20).groupBy((F.col("id") < 60_000).alias("own")).agg(F.count_if("_maybe").alias("n"), F.count("*").alias("all"))
    counts = {r.own: (r.n, r.all) for r in seen.collect()}
    assert counts[True] == (60_000, 60_000) and counts[False][0] < 0.03 * counts[False][1]


def test_bits_are_those_of_the_bitmap(spark):
    bits = spark.range(0, 64, 7).agg(F.bitmap_construct_agg("id").alias("bits"))
    got = bits.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(64)), lambda p: F.when(bloom.is_set(F.col("bits"), p), p))).alias("p")).dropna()
    assert sorted(r.p for r in got.collect()) == list(range(0, 64, 7))


def test_outside_equals_the_plain_anti_join(spark, frame):
    items = frame([("a", 1), ("a", 1), (None, 2), ("", 3), ("new", 4), ("b", 5)], "id string, _x int")
    known = frame([("a",), ("a",), (None,), ("",), ("c",)], "id string")
    for stored in (known, known.limit(0)):
        got = bloom.outside(items, stored, bloom.filters(stored, blocks=4), blocks=4)
        assert sorted(map(str, got.collect())) == sorted(map(str, items.join(stored, "id", "left_anti").select("id", "_x").collect()))
    parts = bloom.filters(known)
    assert [r.id for r in membership.missing_files(items, known, filters=parts).collect()] == [None, "b", "new"]
    assert {r.id for r in membership.stale_prune(items, known, filters=parts).collect()} == {None, "b", "new"}


def test_store_answers_by_its_filters(spark, frame, tmp_path):
    path, fields = str(tmp_path / "records"), "id string, status string, record string"
    for n, signature in enumerate(("120000000000", "1e0000000000")):  # names that look like numbers
        incremental.append_records(frame([(f"a{n}", "ok", "r"), ("b", "retry:timeout", None)], fields), path, "energy", signature, n)
    incremental.append_records(frame([("late", "ok", "r")], fields), path, "energy", "120000000000", 9)
    items = frame([("a0",), ("a1",), ("b",), ("late",)], "id string")
    left = {s: sorted(r.id for r in incremental.unrecorded(items, path, "energy", s).collect()) for s in ("120000000000", "1e0000000000")}
    assert left == {"120000000000": ["a1", "b"], "1e0000000000": ["a0", "b", "late"]}
    stored = incremental.stored_records(spark, path, "energy", "1e0000000000")
    assert [r.id for r in stored.collect()] == ["a1"]


def test_unknown_ids_alone_are_computed(spark):
    cache = spark.range(100).withColumn("n", F.lit(0).cast("long"))
    asked = []

    def compute(ids):
        asked.append(ids.count())
        return ids.withColumn("n", F.lit(1).cast("long"))

    whole = incremental.cache_upsert(cache, spark.range(150), compute, filters=bloom.filters(cache, blocks=bloom.BLOCKS))
    assert asked == [50] and whole.count() == 150 and whole.filter("n = 1").agg(F.min("id")).first()[0] == 100

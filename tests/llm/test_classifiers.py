import numpy as np
import pytest
from pyspark.sql import functions as F

from contactforge.llm import language_id, quality
from contactforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op5_language_id"](spark, SMALL)
    assert got.count() == docs.count()
    held = got.join(docs, "doc_id").filter("held_out and lang_pred <> 'und'")
    right = held.filter("lang_pred = lang").count()
    assert right / held.count() > 0.97
    assert got.filter("rejected").count() < 0.01 * got.count()


def test_language_edges(spark, docs):
    learn = docs(["the cat sat on the mat with the hat", "and then the dog ran to the house", None, ""])
    model = language_id.train(learn, F.lit(True))
    rows = {r["doc_id"]: r for r in language_id.predict(docs([None, "", "123 ?!", "the mat", "日本語の文章です", "the " * 50_000, "the mat"]), model).collect()}
    assert [rows[i]["lang_pred"] for i in range(7)] == ["und", "und", "und", "en", "en", "en", "en"]
    assert all(rows[i]["score"] == 0 and rows[i]["rejected"] for i in range(3)) and rows[4]["rejected"] and not rows[3]["rejected"]
    nothing = language_id.train(learn.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language_id.predict(learn, nothing).collect()} == {"und"}
    assert language_id.predict(learn.limit(0), model).count() == 0


def test_smoothing_sums_to_one():
    texts = ["abracadabra abba", "cab bad dab"]
    code, start, _ = language_id.coded(texts)
    key, n = np.unique(language_id.grams(code, start, language_id.ORDER), return_counts=True)
    model = language_id.smoothed({0: (key, n)}, ["x"])
    alphabet = np.unique(np.append(code, ord("z"))).astype(np.uint64)
    for context in ([0, ord("a"), ord("b")], [ord("r"), ord("a"), ord("c")], [ord("z")] * 3):
        lines = np.array([[*context, c] for c in alphabet], np.uint64).ravel()
        p = np.exp(model.log_probability(language_id.grams(lines, np.arange(0, len(lines) + 1, 4), language_id.ORDER)))[3::4, 0]
        unseen = (1 << language_id.CHAR_BITS) - len(alphabet)
        assert p.sum() + unseen * p[-1] == pytest.approx(1, abs=1e-3)


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op4_quality"](spark, SMALL).join(labels, "doc_id").filter("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    assert right > 0.9
    assert right > max(np.mean([r["quality"] for r in rows]), 0.5)


def test_quality_edges(spark, docs):
    model = quality.descend([(np.array([1, 2]), np.array([1, 1]), 1), (np.array([3]), np.array([2]), 0), (np.array([], int), np.array([], int), 1)], 64)
    rows = quality.score(docs([None, "", " \n", "x", "long " * 100_000, "x"]), model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    same = {r["doc_id"]: r["score"] for r in rows}
    assert same[0] == same[1] == same[2] and same[3] == same[5]
    none = spark.createDataFrame([], "doc_id long, text string, quality int")
    assert {r["score"] for r in quality.score(docs(["a", None]), quality.train(none)).collect()} == {0.5}
    assert quality.score(docs(["a"]).limit(0), model).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["", "ab cd", "ä", " ", "ab cd"]
    bucket, owner = quality.features(texts)
    for i, t in enumerate(texts):
        alone, _ = quality.features([t])
        assert sorted(bucket[owner == i]) == sorted(alone)

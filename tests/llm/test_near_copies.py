import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactforge.llm import decontaminate, jaccard_join
from contactforge.llm.components import components

SMALL = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def grams(w, k=5):
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else [])


def brute_components(texts):
    sets = {i: set(grams(words(t))) for i, t in texts.items()}
    by_gram, root = {}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(texts):
        shared = Counter(j for g in sets[i] for j in by_gram.get(g, ()))
        for j, both in shared.items():
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in sets[i]:
            by_gram.setdefault(g, []).append(i)
    return {i: (len(sets[i]), find(i)) for i in texts}


def made_texts():
    draw = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in draw.integers(0, 5000, n)]
    passage, texts = word(60), [None, "", " \n", "one two", "One  two", "a b c d", "a b c d e"]
    for size in (20, 60, 200, 400):
        base = word(size)
        for _ in range(12):  # near copies with more and more edits
            copy = list(base)
            for at in draw.integers(0, size, int(draw.integers(0, max(2, size // 25)))):
                copy[at] = "edit" + str(draw.integers(0, 9))
            texts.append(" ".join(copy))
        for _ in range(6):
            texts.append(" ".join(word(size // 2) + passage + word(size // 2)))
    chain = word(100)
    texts += [" ".join(chain[i : i + 70]) for i in range(0, 30, 3)]  # links along a chain
    return texts + ["long " + " ".join(word(30_000))] * 2


@pytest.mark.parametrize("part_bytes", [8_000_000, 3_000])
def test_components_equal_brute_force(docs, monkeypatch, part_bytes):
    monkeypatch.setattr(jaccard_join, "PART_BYTES", part_bytes)
    texts = made_texts()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs(texts)).collect()}
    assert got == brute_components(dict(enumerate(texts)))


def test_given_documents(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(frame).collect()}
    assert got == brute_components({r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()})


def test_null_and_repeated_ids(spark):
    frame = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "x y z"), (2, "x y z"), (None, None)], "doc_id long, text string")
    rows = sorted((r["doc_id"] is None, r["component_id"]) for r in jaccard_join.jaccard_components(frame).filter("doc_id is not null").collect())
    assert [c for _, c in rows] == [1, 1, 1] and jaccard_join.jaccard_components(frame).count() == 5
    assert jaccard_join.jaccard_components(frame.limit(0)).count() == 0


def test_star_contraction(spark):
    draw = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}
    for a, b in pairs:
        root.setdefault(a, {a}), root.setdefault(b, {b})
        if root[a] is not root[b]:
            joined = root[a] | root[b]
            for x in joined:
                root[x] = joined
    assert got == {x: min(s) for x, s in root.items() if len(s) > 1}


def brute_findings(texts, items):
    out = {}
    for item, text in items.items():
        own = words(text)
        k, want = min(5, len(own)), Counter(grams(own))
        for doc, t in texts.items():
            w, best = words(t), None
            if not own or len(w) < k or not set(grams(w, k)) & set(want):
                continue
            for start in range(max(1, len(w) - len(own) + 1)):
                have = Counter(grams(w[start : start + len(own)], k))
                both = sum((have & want).values())
                share = both / (sum(have.values()) + sum(want.values()) - both)
                if share >= 0.8 and (best is None or share > best[1] + 1e-12):
                    best = (start, share)
            if best:
                out[doc, item] = best
    return out


def test_findings_equal_brute_force(spark, docs):
    draw = np.random.default_rng(3)
    word = lambda n: [f"v{x}" for x in draw.integers(0, 900, n)]
    items = {i: word(int(draw.integers(12, 60))) for i in range(12)}
    items |= {20: ["tiny", "item"], 21: [], 22: ["again"] * 30}
    texts = [None, "", "tiny item", "a TINY Item b", " ".join(["again"] * 31), "again " * 28]
    for i in range(12):
        own = items[i]
        edited = list(own)
        edited[1] = "changed"
        longer = own[:9] + ["more"] + own[9:]
        for version in (own, edited, own[2:], longer, own[: len(own) // 2], [w.upper() for w in own]):
            texts.append(" ".join(word(40) + version + word(30)))
        texts += [" ".join(own), " ".join(own + own), " ".join(own[1:])]
    texts += [" ".join(word(20_000)), " ".join(word(50)), " ".join(word(50))]
    bench = spark.createDataFrame([(i, " ".join(w) if w else None) for i, w in items.items()], "item_id long, text string")
    found = decontaminate.findings(docs(texts), bench)
    got = {(r["doc_id"], r["item_id"]): (r["first_word"], round(r["similarity"], 9)) for r in found.collect()}
    want = {k: (a, round(s, 9)) for k, (a, s) in brute_findings(dict(enumerate(texts)), {i: " ".join(w) for i, w in items.items()}).items()}
    assert got == want
    left = decontaminate.without_findings(docs(texts), found)
    assert {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.findings(docs(texts).limit(0), bench).count() == 0 and decontaminate.findings(docs(texts), bench.limit(0)).count() == 0


def test_repeated_shingles_void_no_finding(spark):
    """Few distinct shingles with other weights: fingerprints far apart, similarity above the threshold."""
    alternate = lambda first, second, n: " ".join([first, second][i % 2] for i in range(n))
    stuck = [f"w{i}" for i in range(200)]
    items = {0: alternate("a", "b", 25), 1: " ".join(stuck), 2: "x " * 12}
    texts = [alternate("b", "a", 25), " ".join(stuck[:172] + ["w171"] * 28), "x " * 10, "y " * 40 + alternate("b", "a", 26), alternate("a", "c", 25)]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    twice = decontaminate.findings(docs.unionByName(docs), bench.unionByName(bench))
    got = {(r["doc_id"], r["item_id"]): (r["first_word"], round(r["similarity"], 9)) for r in twice.collect()}
    want = {k: (a, round(s, 9)) for k, (a, s) in brute_findings(dict(enumerate(texts)), items).items()}
    assert got == want and (0, 0) in got and (3, 0) in got


def test_findings_of_whole_tables_equal_brute_force(spark):
    """Every document of sf0.001 and planted edits of every item beside it: none is lost."""
    folder = "/root/testdata/sf0.001"
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    items, texts = dict(tuple(r) for r in bench.collect()), dict(tuple(r) for r in docs.collect())
    draw, planted = np.random.default_rng(9), []
    for i, (_, text) in enumerate(sorted(items.items())):
        w = words(text)
        for edits in range(3):
            changed = list(w)
            for at in draw.integers(0, len(w), edits) if w else []:
                changed[at] = f"edit{at}"
            planted.append((10_000_000 + 3 * i + edits, "before it " * edits + " ".join(changed) + " and after"))
    texts.update(planted)
    found = decontaminate.findings(docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string")), bench)
    rows = found.collect()
    want = {k: round(s, 9) for k, (_, s) in brute_findings(texts, items).items()}
    assert len(want) > len(items) and {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows} == want
    for r in rows:  # the window that is named has that similarity
        window = " ".join(words(texts[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_words"]])
        assert brute_findings({0: window}, {0: items[r["item_id"]]})[0, 0] == (0, pytest.approx(r["similarity"]))


def test_simhash_is_the_majority_of_bits(spark):
    draw = np.random.default_rng(4)
    rows = [([int(x) for x in draw.integers(-(2**63), 2**63 - 1, n)],) for n in (1, 2, 7, 33)]
    for r in spark.createDataFrame(rows, "h array<long>").select("h", decontaminate.simhash(F.col("h")).alias("s")).collect():
        want = sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in r["h"]) > len(r["h"]))
        assert r["s"] % 2**64 == want

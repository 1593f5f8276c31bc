"""Alignment and counts against a plain version over whole texts."""
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from contactforge.llm import cross_tokenizer as X

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", "\n\n a", "x \n y\n  z", "日本語のテキスト 😀😀 é́", "<s> </s> <|endoftext|> [INST] <unk> <0x41>", "x" * 700, "ab" * 400, "word ▁ word", "　　a  b\t\tc \x85 x\x1c\x1dy",
    "don't we'll I'M 12345 ½²Ⅷ", "aaaa " * 50, "a\x00b", "\r\n\r\n  x", "".join(map(chr, range(0x100, 0x600))), "the cat sat on the mat. " * 20000, "same row", "same row", " the" * 3,
]


@pytest.fixture(scope="module")
def tools():
    return X.Tokenizers(A, B)


def plain(texts: dict, tools) -> dict:
    """Whole texts, no units; counts in one table."""
    out, links = {}, {}
    for key, text in texts.items():
        out[key], links[key] = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": ""}, []
        if not text:
            continue
        a, b, raw = tools.a.encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text), (" " + text).encode()
        if b"".join(tools.bytes_a[i] for i in a) != raw or b"".join(tools.bytes_b[i] for i in b) != raw:
            continue
        ends = dict(zip(np.cumsum([len(tools.bytes_a[i]) for i in a]).tolist(), range(len(a))))
        groups, at, i, j = [], 0, 0, 0
        for k, token in enumerate(b):
            at += len(tools.bytes_b[token])
            if at in ends:
                groups.append(",".join(map(str, a[i : ends[at] + 1])) + "|" + ",".join(map(str, b[j : k + 1])))
                i, j = ends[at] + 1, k + 1
                links[key].append((a[ends[at]], token))
        out[key] = {"n_a": len(a), "n_b": len(b), "n_groups": len(groups), "n_links": len(links[key]), "groups": ";".join(groups)}
    count = Counter(x for own in links.values() for x in own)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    for key, own in links.items():
        out[key] |= {"n_best": sum(count[x] == best[x[1]] for x in own), "count_sum": sum(count[x] for x in own)}
    return out


@pytest.mark.parametrize("records", [2_000_000, 50], ids=["one run", "many runs"])
def test_odd_and_whole_tables_equal_the_plain_version(docs, documents, tools, monkeypatch, records):
    monkeypatch.setattr(X, "RUN_RECORDS", records)  # workers of a local session read it from the pickled function's module
    for frame in (docs(ODD), documents):
        expected = plain({r["doc_id"]: r["text"] for r in frame.collect()}, tools)
        rows = X.align(frame, A, B).collect()
        assert len(rows) == len(expected)
        for r in rows:
            assert {k: r[k] for k in expected[r["doc_id"]]} == expected[r["doc_id"]], r["doc_id"]


def test_runs_give_every_pair_back_in_order(tools):
    random = np.random.default_rng(5)
    docs = [random.integers(0, 6, n) << X.A_BITS | random.integers(0, 3, n) for n in (0, 1, 5, 40, 40)]
    count = Counter(np.concatenate(docs).tolist())
    runs, places = [], []
    for part in (docs[:2], docs[2:4], docs[4:]):
        run = X.Run(len(runs), 4)
        for links in part:
            run.add(1, links, np.zeros(len(links), np.int64))
        for row in run.rows():
            if row["radix"] == 1:
                runs.append((np.cumsum(X.unpacked(row["pairs"], "<i8")), X.unpacked(row["totals"], "<i8")))
    for (pairs, totals), (counts, best) in zip(runs, X.merged_runs(runs)):
        assert (np.diff(pairs) > 0).all() and counts.tolist() == [count[p] for p in pairs.tolist()]
        top = {b: max(n for p, n in count.items() if p >> X.A_BITS == b) for b in range(6)}
        assert list(best) == [count[p] == top[p >> X.A_BITS] for p in pairs.tolist()]


def test_units_are_learned_again_when_the_store_is_full(tools, monkeypatch):
    texts = ["one two  three", "two\n four", "one five"] * 3
    whole = X.UnitStore(tools).align(texts)
    monkeypatch.setattr(X, "STORE_BYTES", 10)
    store = X.UnitStore(tools)
    for k, text in enumerate(texts):
        numbers, groups, links, _ = store.align([text])
        assert (numbers[0] == whole[0][k]).all() and groups[0] == whole[1][k] and (links == whole[2][whole[3] == k]).all()


def test_shown_columns_and_clashes(docs):
    frame = docs(["ab cd", None]).selectExpr("*", "'old' AS groups", "1 AS n_a")
    out = X.align(frame, A, B, show={"groups_sha256": X.F.when(X.F.col("groups") != "", X.F.sha2("groups", 256)).otherwise("")})
    rows = {r["doc_id"]: r for r in out.collect()}
    assert "groups" not in out.columns and "text" not in out.columns and {"lang", "size", "ids"} <= set(out.columns)
    text = plain({0: "ab cd"}, X.Tokenizers(A, B))[0]["groups"]
    assert rows[0]["groups_sha256"] == hashlib.sha256(text.encode()).hexdigest() and rows[1]["groups_sha256"] == ""


def test_empty_table(docs):
    assert X.align(docs(["a"]).limit(0), A, B).count() == 0


def test_vocabularies_that_cross_the_cut_are_refused():
    with pytest.raises(ValueError):
        X.Tokenizers(P.path("word_bpe_49k.json"), B)


def test_units_are_encoded_together_and_told_apart_by_their_bytes(tools, monkeypatch):
    given, whole = [], tools.a.encode_batch_fast
    monkeypatch.setattr(tools, "encode_a", lambda texts: given.extend(texts) or [e.ids for e in whole(texts, add_special_tokens=False)])
    texts = [" ".join(f"word{i}x{j}" for j in range(300)) for i in range(20)] + ["ends in blanks \n", " \x1c", "", "▁ left out"]
    numbers, groups, links, owner = X.UnitStore(tools).align(texts)
    assert len(given) < 20  # 6,000 units
    for i, own in plain(dict(enumerate(texts)), tools).items():
        assert (numbers[i].tolist() == [own["n_a"], own["n_b"], own["n_links"]]) or not own["groups"]
        assert groups[i] == own["groups"] and (owner == i).sum() == own["n_links"]

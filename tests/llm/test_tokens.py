import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest

from contactforge.llm import byte_bpe, token_counts

RANKS, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", "\n\n a", "日本語のテキスト 😀😀 é́", "<s> </s> [INST] <|endoftext|>", "x" * 700, "ab" * 400, " ▁ ▁▁a",
    "　　a  b\t\tc \x85 x\x1c\x1dy", "don't we'll I'M 12345 ½²Ⅷ", "aaaa " * 50, "한국어 " * 30, "\r\n\r\n  x", "t" * 1000 + "in" * 300,
    "".join(map(chr, range(0x100, 0x600))), "the cat sat on the mat. " * 20000, "same row", "same row",
]


@pytest.fixture(scope="module")
def tiktoken_encode():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_codes_equal_tiktoken_and_come_back(docs, documents, tiktoken_encode):
    for frame in (docs(ODD), documents):
        rows = byte_bpe.decode(byte_bpe.encode(frame, RANKS, P.PATTERN, keep_text=True), RANKS, P.PATTERN, text=True).collect()
        assert len(rows) == frame.count()
        for r in rows:
            text = r["text"] or ""
            assert np.frombuffer(r["ids"], "<u4").tolist() == tiktoken_encode(text)
            assert r["decoded"] == text.encode() and r["decoded_text"] == text and r["n_tokens"] == len(r["ids"]) // 4


def test_offsets_cover_the_text(docs):
    rows = byte_bpe.encode(docs(["日本 😀 a", "plain text", ""]), RANKS, P.PATTERN, offsets=True, keep_text=True).collect()
    for r in rows:
        covered = {k for a, b in zip(r["starts"], r["ends"]) for k in range(a, b)}
        assert covered == set(range(len(r["text"])))


def test_cut_characters_decode_to_replacement(spark, docs):
    whole = byte_bpe.encode(docs(["😀"]), RANKS, P.PATTERN).first()["ids"]
    cut = spark.createDataFrame([(whole[:4],)], "ids binary")
    assert "�" in byte_bpe.decode(cut, RANKS, P.PATTERN, text=True).first()["decoded_text"]


def test_one_pass_equals_two(docs):
    one = byte_bpe.encode(docs(ODD), RANKS, P.PATTERN, decoded=True, decoded_text=True).orderBy("doc_id")
    two = byte_bpe.decode(byte_bpe.encode(docs(ODD), RANKS, P.PATTERN), RANKS, P.PATTERN, text=True).orderBy("doc_id")
    assert one.columns == two.columns and one.collect() == two.collect()


def test_digests(docs):
    out = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs([None, "ab"]), RANKS, P.PATTERN), RANKS, P.PATTERN)).collect()
    assert {r["decoded_sha256"] for r in out} == {hashlib.sha256(x).hexdigest() for x in (b"", b"ab")}


def test_counts_equal_sentencepiece(docs, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for frame in (docs(ODD), documents):
        texts = {r["doc_id"]: r["text"] or "" for r in frame.collect()}
        rows = token_counts.token_counts(frame, PIECES).collect()
        assert len(rows) == len(texts)
        for r in rows:
            n = len(model.encode(texts[r["doc_id"]]))
            assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 4096)


def test_empty_tables(docs):
    none = docs(["a"]).limit(0)
    assert token_counts.token_counts(none, PIECES).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(none, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0


def test_generations_of_units_keep_results(monkeypatch, tiktoken_encode):
    texts = ["one two three", "two four\n one", "one", "", "three three", "one two three"]
    for size in (0, 1000, 10**9):
        monkeypatch.setattr(byte_bpe, "STORE_BYTES", size)
        tool = byte_bpe.Codec(RANKS, P.PATTERN)
        for text in texts:
            assert np.frombuffer(tool.encode([text])[0], "<u4").tolist() == tiktoken_encode(text)
    assert tool.known and not tool.older


def test_full_store_keeps_results(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_UNITS", 2)
    tool = token_counts.Merger(PIECES)
    assert [tool.count([t])[0] for t in ("one two three", "two four", "one")] == [len(tool.model.encode(t)) for t in ("one two three", "two four", "one")]

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactforge.llm import suffix_dedup

SMALL = "/root/testdata/sf0.001"


def brute(rows, length=50):
    """Per row (id, text): the removed byte mask."""
    least = {}
    top = 2**63 - 1
    for i, t in rows:
        raw, i = (t or "").encode(), top if i is None else i
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            least[w] = min(least.get(w, top), i)
    out = []
    for i, t in rows:
        raw, key = (t or "").encode(), top if i is None else i
        mask = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if least[raw[s : s + length]] < key:
                mask[s : s + length] = True
        out.append((i, len(raw), int(mask.sum()), int(mask[0:1].sum() + (mask[1:] & ~mask[:-1]).sum()), bytes(np.frombuffer(raw, np.uint8)[~mask])))
    return out


def result(frame):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.deduplicate(frame).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def made_texts():
    draw = np.random.default_rng(6)
    text = lambda n, letters="abcdefghij klmn é": "".join(draw.choice(list(letters), n))
    passage, base = text(130), text(900)
    texts = [None, "", "short", "x" * 49, "x" * 50, "x" * 300, "ab" * 200, "ab" * 40, passage, passage]
    for _ in range(10):
        texts.append(text(int(draw.integers(10, 300))) + passage[: int(draw.integers(45, 130))] + text(80))
        copy = list(base)
        for at in draw.integers(0, 900, 6):
            copy[at] = "#"
        texts.append("".join(copy))
        texts.append(text(100) + "é" * int(draw.integers(20, 40)) + text(20) + passage[int(draw.integers(0, 80)) :])
    return texts + [text(70_000), text(60_000) + base]


@pytest.mark.parametrize("block,part", [(4_000_000, 2_000_000), (1_500, 3_000)])
def test_equals_brute_force(docs, monkeypatch, block, part):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", part)
    texts = made_texts()
    frame = docs(texts).withColumn("kept", F.lit("clash"))
    assert ordered(result(frame)) == ordered(brute(list(enumerate(texts))))


def test_given_documents(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    assert ordered(result(frame)) == ordered(brute(rows))


def test_null_and_repeated_ids(spark):
    a, b = "first sentence of a document that is long enough to be found", "another sentence of a document, long enough to be found too"
    rows = [(3, a), (3, a), (None, a), (None, b), (None, b), (5, a + b)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(result(frame)) == ordered(brute(rows))
    assert suffix_dedup.deduplicate(frame.limit(0)).count() == 0


def test_text_of_a_cut_character(docs):
    shared = "é" * 30
    row = suffix_dedup.deduplicate(docs([shared, "ab" + shared[1:] + "é"]), as_text=True).filter("doc_id = 1").first()
    assert row["kept_text"] == row["kept"].decode("utf-8", "ignore")


def test_pieces_of_a_block_join(monkeypatch):
    draw = np.random.default_rng(8)
    data = draw.integers(97, 100, 4000).astype(np.uint8)
    start = np.array([0, 1000, 1000, 1030, 4000])
    whole = suffix_dedup.anchors(data, start)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(*whole[1:])])
    valid = [s for a, b in zip(start[:-1], start[1:]) for s in range(a, b - 49)]
    assert covered.tolist() == valid
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    split = suffix_dedup.anchors(data, start)
    owner = lambda x: np.repeat(x[0], x[2] - x[1] + 1).tolist()
    assert owner(split) == owner(whole)


def test_sorted_like_strings():
    draw = np.random.default_rng(9)
    text = np.concatenate([draw.integers(97, 99, 3000), np.tile(draw.integers(0, 255, 60), 20), np.zeros(60)]).astype(np.uint8)
    starts = np.arange(len(text) - 58)
    order, edge = suffix_dedup.deep_shallow(text, starts)
    strings = [text[s : s + 50].tobytes() for s in starts[order]]
    assert strings == sorted(strings)
    assert edge.tolist() == [i == 0 or strings[i] != strings[i - 1] for i in range(len(strings))]


def test_a_hot_passage_costs_a_partition_its_distinct_stretches(docs):
    draw = np.random.default_rng(11)
    passage = "".join(draw.choice(list("abcdefghij klmn"), 200))
    texts = [passage] * 400
    blocks = suffix_dedup.make_blocks(docs(texts).coalesce(1), "text").cache()
    flags = suffix_dedup.send_anchors(blocks, "doc_id", "text", 8).groupBy("part").applyInPandas(suffix_dedup.shared_anchors, "block long, part int, bits binary")
    sent = suffix_dedup.send_stretches(blocks, flags, "doc_id", "text", 8).toPandas()
    arrays = [suffix_dedup.unpack(p) for p in sent["packed"]]
    assert 0 < sum(len(a[1]) for a in arrays) <= 151
    assert all(len(x) == len(a[1]) for a in arrays for x in a[2:])
    back = suffix_dedup.repeated_windows(sent[sent["part"] == sent["part"].iloc[0]])
    assert sum(len(x) for p in back["spans"] for x in suffix_dedup.unpack(p)) <= 5 * 151
    assert ordered(result(docs(texts).coalesce(1))) == ordered(brute(list(enumerate(texts))))

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from contactforge.llm import chat, sharding
from contactforge.llm.queries import QUERIES

from .conftest import SF

TURNS = [
    (1, 0, "system", "be\\kind"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "<|start|>x<|sep|>\\<|end|>"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "\\\\<\\s>😀"), (2, 0, "user", "only"), (3, 0, None, None),
    (4, 0, "assistant", "a"), (4, 0, "assistant", "a"), (4, 0, "assistant", "b"), (None, None, "<s>", "x"), (None, 1, "assistant", "y"),
]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[conv] = len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    return out


def test_examples_and_digests(spark):
    frame = spark.createDataFrame([(*r, 9) for r in TURNS], "conv_id long, turn long, role string, text string, example_no int")
    examples = chat.prefix_examples(frame)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(examples).collect()}
    assert got == expected(TURNS)
    rows = examples.filter("conv_id = 1").orderBy("example_no").collect()
    assert len(rows) == 3 and all(b["text"].startswith(a["text"]) for a, b in zip(rows, rows[1:]))
    for r in rows:  # nothing but the last reply is trainable
        assert r["loss_start"] + r["loss_chars"] + len(chat.END) == len(r["text"])
        assert not any(m in r["text"][r["loss_start"]:][: r["loss_chars"]] for m in chat.CONTROL)
    open_ = examples.filter("conv_id = 2").collect()
    assert len(open_) == 1 and open_[0]["loss_chars"] is None


def test_no_conversation(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.prefix_examples(none)).count() == 0


def test_shards_are_even_and_slots_gapless(docs, documents):
    odd = docs([None, "", "x" * 100_000, "same", "same"] + ["word " * (i % 50) for i in range(500)])
    for frame in (documents, odd, odd.unionByName(odd)):
        placed, folder = sharding.shard_documents(frame)
        rows = placed.collect()
        assert len(rows) == frame.count()
        texts = {r["doc_id"]: (r["text"] or "").encode() for r in frame.collect()}
        load = dict.fromkeys(range(8), 0)
        for shard in range(8):
            own = [r for r in rows if r["shard"] == shard]
            assert sorted(r["slot"] for r in own) == list(range(len(own)))
            load[shard] = sum(r["size"] for r in own)
        assert all(r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)
        largest = max(r["size"] for r in rows)
        assert max(load.values()) - min(load.values()) <= 2 * largest
        versions = placed.sparkSession.read.parquet(folder)
        assert versions.groupBy("version").count().filter("count <> 4096").count() == 0 and versions.select("version").distinct().count() == 2


def test_edits_move_few_slots_and_growth_fills_the_new_shard():
    weight = [10] * 64
    even = [i % 8 for i in range(64)]
    assert sharding.edited(even, weight, 8) == even
    grown = sharding.edited(even, weight, 9)
    moved = [(a, b) for a, b in zip(even, grown) if a != b]
    assert moved and all(b == 8 for _, b in moved) and grown.count(8) in (7, 8)


def test_empty_table_shards(docs):
    assert sharding.shard_documents(docs(["a"]).limit(0))[0].count() == 0


@pytest.mark.parametrize("name", ["op1_prefix_targets", "op8_virtual_slots", "op9_benchmark_findings", "op11_license_scan"])
def test_main_path_has_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_conversation_seven(spark):
    row = QUERIES["op1_prefix_targets"](spark, SF).filter(F.col("conv_id") == -7).first()
    assert row["n_turns"] == 2 and row["loss_sha256"] == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()

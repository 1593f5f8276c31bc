import base64

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from contactforge.session import staged

from .test_near_copies import brute_components, brute_findings
from .test_suffix_dedup import brute

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL))
        out.append({r["doc_id"]: r.asDict() for r in docs.collect()})
    return out


def test_each_stage_equals_a_plain_version(spark, stages):
    given = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    known, single, cut, clean, ids = stages
    assert set(known) <= set(given) and len(known) > 0.98 * len(given)
    groups = brute_components({i: r["text"] for i, r in known.items()})
    assert set(single) == {c for _, c in groups.values()}
    plain = {i: kept.decode("utf-8", "ignore") for i, _, _, _, kept in brute([(i, r["text"]) for i, r in single.items()])}
    assert {i: r["text"] for i, r in cut.items()} == {i: t for i, t in plain.items() if t}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.values())
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    found = {d for d, _ in brute_findings({i: r["text"] for i, r in cut.items()}, items)}
    assert found and set(clean) == set(cut) - found
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    encode = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    assert set(ids) == set(clean)
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == encode(clean[i]["text"]) and r["text"] == clean[i]["text"] for i, r in ids.items())


def test_columns_stay(spark, stages):
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    assert all(list(next(iter(s.values()))) == columns for s in stages[:-1])


def test_empty_table_and_odd_rows(spark, docs):
    odd = docs([None, "", "the and of the", "x" * 200, "x" * 200], extra=True)
    for frame in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, SMALL).count() <= frame.count()

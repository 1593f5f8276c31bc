"""From raw documents to token ids: language, near copies, repeated passages, benchmark items, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns rows that are written as Parquet and read again for the
next one. All but the last return the columns of ``documents``; columns beside ``doc_id`` and ``text`` are passed on.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from contactforge.llm import byte_bpe, decontaminate, jaccard_join, language_id, suffix_dedup
from contactforge.session import staged


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language model learned from the labelled ones accepts."""
    model = language_id.train(docs, F.lit(True))
    return language_id.predict(docs, model).filter(~F.col("rejected")).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of every group that links at 80 %."""
    return jaccard_join.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document has word for word; a document of which nothing is left goes."""
    cut = suffix_dedup.deduplicate(docs, as_text=True).filter((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    new = {"text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.select([new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    found = decontaminate.findings(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.without_findings(docs, found)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed ids and their number; ``text`` is what they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.encode(docs, *vocabulary, decoded_text=True).withColumnRenamed("decoded_text", "text")


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", without_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]

#: Learned models, bytes cut inside characters and token ids are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs)
    return docs

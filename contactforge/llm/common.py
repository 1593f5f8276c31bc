"""Small helpers shared by the operators of this subpackage."""
from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows that may be broadcast once they have been counted; larger tables take a shuffle join.
BROADCAST_ROWS = 2_000_000

#: Text bytes that a Python task holds at once; a single longer text is taken alone.
CHUNK_BYTES = 1_000_000


#: Bytes of an Arrow batch on its way to Python; a number of rows bounds nothing where texts differ in length.
BATCH_BYTES = 4_000_000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``: the fixed split into learning and held-out rows."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are few, else left to a shuffle join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends Arrow batches of ``BATCH_BYTES`` (and a row) unless its owner set another size."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) is None:
        conf.set(name, str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Return what this Python worker has freed to the system: it outlives its task, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a piece stay near ``limit`` bytes (one row at least)."""
    for batch in batches:
        start = held = 0
        for i, size in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            if i > start and held + (size or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)
        give_back()


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]

"""Incremental state as plain tables: ledgers, record stores, caches, and a bounded stream that feeds them."""
from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import bloom


def first_release_ledger(ledger: DataFrame, current: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """(new ledger, current entries with their first release).

    Known ids keep their date, new ids get ``date``, absent ids stay in the ledger. Keys are unique on both
    sides, so one full outer join on the id is balanced.
    """
    joined = ledger.join(current.select("id").distinct().withColumn("_now", F.lit(True)), "id", "full_outer")
    stamped = joined.withColumn("first_release", F.coalesce("first_release", F.lit(date).cast("date")))
    return stamped.select("id", "first_release"), stamped.filter(F.col("_now")).select("id", "first_release")


def persist_policy(records: DataFrame) -> DataFrame:
    """Outcomes worth storing: everything but ``retry:`` statuses."""
    return records.filter(~F.col("status").startswith("retry:"))


def cache_upsert(cache: DataFrame, items: DataFrame, compute: Callable[[DataFrame], DataFrame], key: str = "id", filters: DataFrame | None = None) -> DataFrame:
    """Compute only the items the cache does not know and return cache plus new rows.

    With the ``filters`` of the cached ids, only what they may hold is looked for in the cache.
    """
    unknown = bloom.outside(items.select(key).distinct(), cache, filters, key)
    return cache.unionByName(compute(unknown))


def known_folder(path: str) -> str:
    """Where the filters of a record table lie: beside it."""
    return f"{path.rstrip('/')}.known"


def append_records(records: DataFrame, path: str, stage: str, signature: str, sequence: int | None = None, blocks: int = bloom.BLOCKS) -> None:
    """Append storable outcomes to the record table, partitioned so a reader prunes to one stage and signature.

    ``sequence`` orders the calls (the clock by default); a later outcome of an id replaces an earlier one. The
    filters of the ids are written first: an append that fails in between leaves bits too many, never one too few.
    ``blocks`` stays the same for the life of a table.
    """
    number = time.time_ns() if sequence is None else sequence
    kept = persist_policy(records).select(F.lit(stage).alias("stage"), F.lit(signature).alias("signature"), "id", "status", "record", F.lit(number).cast("long").alias("sequence"))
    bits = bloom.filters(kept, blocks=blocks).select(F.lit(stage).alias("stage"), F.lit(signature).alias("signature"), "block", "bits")
    bits.write.mode("append").partitionBy("stage", "signature").parquet(known_folder(path))
    kept.write.mode("append").partitionBy("stage", "signature").parquet(path)


def stored_filters(spark: SparkSession, path: str, stage: str, signature: str) -> DataFrame:
    """``DF[block, bits]`` of one stage and signature, a row for each append."""
    return _stage_rows(spark, known_folder(path), stage, signature).select("block", "bits")


def unrecorded(items: DataFrame, path: str, stage: str, signature: str, key: str = "id", blocks: int = bloom.BLOCKS) -> DataFrame:
    """Items without a stored outcome; ids that the filters deny do not touch the record table."""
    spark = items.sparkSession
    ids = _stage_rows(spark, path, stage, signature).select(F.col("id").alias(key))
    return bloom.outside(items, ids, stored_filters(spark, path, stage, signature), key, blocks)


def _stage_rows(spark: SparkSession, path: str, stage: str, signature: str) -> DataFrame:
    """One stage and signature of a record or filter table; both names are texts, also where they look like numbers."""
    found = spark.read.parquet(path).schema
    schema = StructType([StructField(f.name, StringType()) if f.name in ("stage", "signature") else f for f in found.fields])
    return spark.read.schema(schema).parquet(path).filter((F.col("stage") == stage) & (F.col("signature") == signature))


def stored_records(spark: SparkSession, path: str, stage: str, signature: str) -> DataFrame:
    """Latest stored outcomes of one stage under one parameter signature."""
    table = _stage_rows(spark, path, stage, signature)
    last = F.max(F.struct("sequence", "status", "record")).alias("last")
    return table.groupBy("id").agg(last).select("id", "last.status", "last.record")


def newest_version(spark: SparkSession, ledger_path: str) -> int | None:
    """The highest ``v=`` folder of a ledger, or None where there is none yet."""
    try:
        return spark.read.parquet(ledger_path).agg(F.max("v")).first()[0]
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def follow_snapshots(spark: SparkSession, folder: str, schema: str, ledger_path: str, date: str, checkpoint: str) -> int:
    """Fold every snapshot file that has appeared since the last run into a versioned ledger.

    An ``availableNow`` file stream remembers which files it has seen; each micro-batch folds its rows into the
    newest version present and writes the next one. Known ids keep their date, so a batch that is replayed, or
    all of them after a lost checkpoint, changes nothing. Returns the number of the newest version, -1 without one.
    """
    def fold(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        newest = newest_version(session, ledger_path)
        if newest is None:
            before = session.createDataFrame([], "id string, first_release date")
        else:
            before = session.read.parquet(f"{ledger_path}/v={newest}")
        ledger, _ = first_release_ledger(before, batch, date)
        ledger.write.mode("overwrite").parquet(f"{ledger_path}/v={0 if newest is None else newest + 1}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (
        stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    newest = newest_version(spark, ledger_path)
    return -1 if newest is None else newest

"""Session helpers shared by plans, tests and the benchmark."""
from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "contactforge", memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks. On a cluster the submitter's session is used as is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Hand this package to the workers of a session, once: they need neither its folder nor an installed copy."""
    context = spark.sparkContext
    if not getattr(context, "_contactforge_shipped", False):
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='contactforge-')}/contactforge", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context._contactforge_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def balanced(scan: DataFrame) -> DataFrame:
    """Spread a table *scan* that arrives in fewer pieces than there are cores.

    Only a small input can be in that position, so only small inputs are ever shuffled here; a large table
    already has more splits than cores and passes through untouched.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="contactforge-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Cut lineage at a table that several branches reuse.

    The rows are written as parquet to the shared folder and read back, so lost executors cost nothing and
    every later branch keeps column pruning, pushed filters and exact sizes.
    """
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Bytes of an Arrow batch on its way to Python; a number of rows bounds nothing where rows differ in length.
BATCH_BYTES = 4_000_000


def byte_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends Arrow batches of ``BATCH_BYTES`` (and a row) unless its owner set another size."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) is None:
        conf.set(name, str(BATCH_BYTES))
    return df

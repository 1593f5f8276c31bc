"""Sinks: delimited tables, sharded entry files, FASTA, contacts, structures, clusters and releases."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.text import entry_shard, sanitize, structure_shard
from ..operators.features import project_ordered
from .committed import write_committed


def text_lines(df: DataFrame, sep: str) -> DataFrame:
    """Each row as one line of sanitised cells."""
    cells = [sanitize(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in df.columns]
    return df.select(F.concat_ws(sep, *cells).alias("value"))


def headed_parts(df: DataFrame, path: str, key: str = "id", sep: str = ";", header: list[str] | None = None) -> None:
    """Sorted, sanitised delimited table with a header in every part file, as readers of header-named files take it."""
    lines = text_lines(df.orderBy(key), sep).select(F.col("value").alias(sep.join(header or df.columns)))
    lines.write.mode("overwrite").option("header", True).option("quote", "").option("sep", "\u0001").option("emptyValue", "").csv(path)


def write_final(df: DataFrame, path: str, key: str = "id", sep: str = ";", header: list[str] | None = None) -> None:
    """Sorted, sanitised delimited table with one header, committed as a whole; its parts joined by name are the published file.

    ``header`` replaces the column names at the sink, where a published name may occur twice.
    """
    names = header or df.columns
    write_committed(text_lines(df.orderBy(key), sep), path, sep.join(names), names)


def entry_lines(df: DataFrame, key: str = "id", order: list[str] | None = None, sep: str = ";") -> DataFrame:
    """``DF[shard, value]``: one headerless line per entry, in the target order if given."""
    named = df.withColumn("_key", F.col(key).cast("string"))
    chosen = project_ordered(df, order) if order else df
    cells = [f"`{c}`" for c in chosen.columns]
    if order:
        named = project_ordered(named.withColumnRenamed("_key", "_entry"), [*order, "_entry"]).withColumnRenamed("_entry", "_key")
    line = F.concat_ws(sep, *[sanitize(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cells])
    return named.select(entry_shard(F.col("_key")).alias("shard"), line.alias("value"))


def split_per_entry(df: DataFrame, path: str, key: str = "id", order: list[str] | None = None) -> None:
    """Entry lines in folders by the first character; tasks write their own shards, so nothing is shuffled."""
    write_committed(entry_lines(df, key, order), path)


def write_summary(df: DataFrame, path: str) -> None:
    """The positional summary: tab-separated, no header."""
    from ..operators.features import explore_projection

    write_committed(text_lines(explore_projection(df), "\t"), path)


def write_fasta(records: DataFrame, path: str) -> None:
    """Records of two lines each, committed as a whole."""
    write_committed(records, path)


def contacts_publish(contacts: DataFrame, path: str, key: str = "id") -> None:
    """Contact rows in folders by the entry's first character, each with one header, committed as a whole."""
    rows = contacts.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in contacts.columns])).alias("value"), entry_shard(F.col(key)).alias("shard"))
    write_committed(rows, path, ",".join(contacts.columns), contacts.columns)


def structures_publish(atoms: DataFrame, path: str) -> None:
    """Entry atoms in folders by the middle characters of the structure id."""
    atoms.withColumn("shard", structure_shard(F.col("pdb"))).write.mode("overwrite").partitionBy("shard").parquet(path)


def cluster_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """All cluster tables as ``DF[kind, label, member]`` from ``{kind: DF[label, member]}``."""
    rows = [df.select(F.lit(kind).alias("kind"), F.col("label").cast("string"), F.col("member").cast("string")) for kind, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def cluster_tables_publish(tables: dict[str, DataFrame], path: str) -> None:
    cluster_tables(tables).write.mode("overwrite").partitionBy("kind").option("sep", "\t").csv(path)


def counted_write(deliverables: dict[str, DataFrame], write: Callable[[str, DataFrame], None], label: str = "deliverable") -> DataFrame:
    """Write every frame by ``write(name, frame)`` and count its rows on the way: ``DF[label, n]``, one row a name.

    The counts are metrics of the writing jobs, so nothing is read or computed a second time; a number for each
    name is all that reaches the driver. The counter sits last before the sink, where a retried task counts once.
    """
    counts = []
    for name, df in deliverables.items():
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        write(name, df.observe(seen, F.count(F.lit(1)).alias("n")))
        counts.append((name, seen.get["n"]))
    spark = next(iter(deliverables.values())).sparkSession
    return spark.createDataFrame(counts, f"{label} string, n long")


def release_snapshot(deliverables: dict[str, DataFrame], path: str, date: str, name: str = "release") -> DataFrame:
    """Immutable dated copy of the deliverables with a manifest; an existing release is an error."""
    target = f"{path}/{name}-{date}"
    counts = counted_write(deliverables, lambda label, df: df.write.mode("errorifexists").parquet(f"{target}/{label}"))
    manifest = counts.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("deliverable", "n")))).alias("counts"))
    manifest = manifest.select(F.to_json(F.struct(F.lit(f"{name}-{date}").alias("release"), F.lit(date).alias("snapshot_date"), "counts")).alias("value"))
    manifest.write.mode("errorifexists").text(f"{target}/manifest")
    return counts

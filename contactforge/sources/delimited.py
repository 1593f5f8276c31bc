"""Delimited and line-oriented sources. Everything is read as text; types are cast where they are used."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import standard_only
from .streams import line_pieces, streamed


def read_delimited(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Header-named rows, all strings; a blank cell is ``""``."""
    reader = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).option("quote", "")
    return reader.option("nullValue", "\u0000").option("emptyValue", "").csv(path).fillna("")


def read_headerless(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Positional rows with the given names."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.option("sep", sep).option("header", False).schema(schema).csv(path)


def read_vectors(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Headerless ``id, v1, v2, ...`` lines as ``DF[id, vec]``."""
    cells = F.split("value", sep)
    return spark.read.text(path).select(cells[0].alias("id"), F.slice(cells, 2, F.size(cells) - 1).cast("array<double>").alias("vec"))


def read_id_list(spark: SparkSession, path: str, column: str = "PDB_ID", sep: str = ";") -> DataFrame:
    """Distinct upper-cased ids: from the named column if the header has it, else one id per line."""
    lines = spark.read.text(path)
    first = lines.first()
    header = first.value.split(sep) if first else []
    ids = read_delimited(spark, path, sep).select(F.col(column).alias("pdb")) if column in header else lines.select(F.col("value").alias("pdb"))
    return ids.select(F.upper(F.trim("pdb")).alias("pdb")).filter(F.col("pdb") != "").distinct()


def line_position() -> Column:
    """Orderable place of a line: file, offset of its split, row within the task."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def _order_batches(path: str) -> Iterator[pa.RecordBatch]:
    n = 0
    for lines in line_pieces(path, "\r"):
        names = [line.strip() for line in lines if line.strip() and not line.startswith("#")]
        yield pa.RecordBatch.from_arrays([pa.array([path] * len(names), pa.string()), pa.array(range(n, n + len(names)), pa.int32()), pa.array(names, pa.string())], names=["file", "at", "name"])
        n += len(names)


def read_column_order(spark: SparkSession, path: str) -> DataFrame:
    """``DF[pos, name]``: one column name per line, blank and ``#`` lines skipped; several files count on in the order of their names."""
    lines = streamed(spark, path, _order_batches, "file string, at int, name string", "()$").drop("pdb")
    sizes = lines.groupBy("file").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(sizes.select("file", before.alias("_before")), "file").select((F.col("_before") + F.col("at")).cast("int").alias("pos"), "name")


def member_rows(lines: DataFrame, value: str = "value", line: str = "line_no") -> DataFrame:
    """``label TAB size TAB m1, m2, ...`` lines to ``DF[line_no, label, pos, member]``.

    Lines with fewer than three fields are dropped; blank members are dropped before positions count.
    """
    fields = F.split(value, "\t")
    members = F.filter(F.transform(F.split(fields[2], ","), lambda m: F.trim(m)), lambda m: m != "")
    kept = lines.filter(F.size(fields) >= 3)
    return kept.select(line, fields[0].alias("label"), F.posexplode(members).alias("pos", "member"))


def read_cluster_members(spark: SparkSession, path: str) -> DataFrame:
    return member_rows(spark.read.text(path).withColumn("line_no", line_position()))


def labelled(rows: DataFrame, seq: str = "seq", target: str = "target", row: str = "row") -> DataFrame:
    """Cleaned sequences of at least three residues with label 1 where the target starts with ``pos``."""
    cleaned = rows.withColumn("_q", standard_only(F.col(seq))).filter(F.length("_q") >= 3)
    label = F.lower(F.trim(F.col(target))).startswith("pos").cast("int")
    return cleaned.select(F.col(row).alias("row"), F.col("_q").alias("seq"), label.alias("y"))


def read_labelled_seqs(spark: SparkSession, path: str) -> DataFrame:
    """A headed, tab-separated (sequence, target) file."""
    reader = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", True)
    rows = reader.schema("seq string, target string").csv(path)
    return labelled(rows.withColumn("row", line_position()))

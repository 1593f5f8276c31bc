"""The extension contract: ``worker(item) -> (record, status)`` over the rows of a table, as a table function.

A worker takes one row as a dict and returns ``(record, status)``. It is a small step that Spark's functions cannot
express; items, keys and results stay in Spark. A row whose worker raises gives a row too, with the status
``retry:<error>`` that is never stored, so that the next run asks for it again.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult
from pyspark.sql.types import StringType, StructType

Worker = Callable[[dict], tuple[object, str]]


def table_function(worker: Worker, record: str = "string", key: str = "id"):
    """A table function over one table argument; its columns are ``key`` (with the type it has there), status and record.

    ``record`` is the type of the worker's records, as DDL. A table without ``key`` is refused when the query is
    analysed, before anything runs.
    """

    made = StructType.fromDDL(f"record {record}")["record"]  # here, where a session parses it

    class Rows:
        @staticmethod
        def analyze(items: AnalyzeArgument) -> AnalyzeResult:
            if not items.isTable:
                raise ValueError("the argument has to be a table")
            types = {f.name: f.dataType for f in items.dataType.fields}
            if key not in types:
                raise ValueError(f"the table has no column {key}")
            out = StructType().add(key, types[key]).add("status", StringType())
            return AnalyzeResult(out.add(made))

        def eval(self, items) -> Iterator[tuple]:
            row = items.asDict(recursive=True)
            try:
                found, status = worker(row)
            except Exception as error:  # a row's own failure is its status; Spark's failures are not raised in here
                found, status = None, f"retry:{type(error).__name__}"
            yield row[key], status, found

    return F.udtf(Rows)


def run_worker(items: DataFrame, worker: Worker, record: str = "string", key: str = "id", by: str | None = None) -> DataFrame:
    """``DF[key, status, record]``: the worker's outcome for every row of ``items``.

    Rows stay where they are; ``by`` deals them by a column first, for workers that gain from seeing equal keys in
    one process. Nulls reach the worker as None, repeated rows are worked on as often as they come, and an empty
    table gives an empty result.
    """
    table = items.asTable()
    return table_function(worker, record, key)(table.partitionBy(by) if by else table)

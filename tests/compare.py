"""Run registered queries beside their SQL twins and compare whole results.

    python tests/compare.py [folder] [name ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "hugeint",
         "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "bool"}


def compare(spark, con, folder: str, name: str, build, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = build(spark, folder)
    got, columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    expected, names = rows_of([d[0] for d in cur.description], cur.fetchall())
    if columns != names:
        return f"columns {columns} != {names}"
    theirs = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for d in cur.description}
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if ours != theirs:
        return f"types {ours} != {theirs}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    bad = [(a, b) for a, b in zip(got, expected) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from contactforge.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, folder, name, build, sql[name])
            else:
                n = len(build(spark, folder).collect())
                problem = None if n else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        if problem:
            failed.append(name)
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if not problem else 'FAIL ' + problem[:900]}{'' if name in sql else ' (rows only)'}", flush=True)
    print("failed:", failed)

"""Compare Spark queries with their SQL twins: same columns, same multiset of rows.

Run as a script for a report: ``python -m tests.oracle_check FOLDER [query ...]``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

import __spark_entry__ as contract


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sort_key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_sort_key)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b and math.copysign(1, a) == math.copysign(1, b)
    return type(a) is type(b) and a == b


def differences(spark, connection, name: str, folder: str) -> list[str]:
    """Empty when query and SQL agree exactly."""
    df = contract.queries()[name](spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} and {sorted(columns)}"]
    if not ours:
        return ["no rows"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows and {len(theirs)} rows"]
    return [
        f"{a} and {b}"
        for a, b in zip(ours, theirs)
        if not all(_same(x, y) for x, y in zip(a, b))
    ]


def main(folder: str, names: list[str]) -> None:
    from cohortmill.session import get_session

    spark = get_session(
        master="local[8]",
        settings={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
        log_level="ERROR",
    )
    connection = sql_connection(folder)
    for name in names or contract.queries():
        start = time.perf_counter()
        if name in contract.oracle_sql():
            found = differences(spark, connection, name, folder)
            verdict = f"{len(found)} differ: {found[:3]}" if found else "same"
        else:
            verdict = f"rows only: {contract.queries()[name](spark, folder).collect()[:3]}"
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s  {verdict[:700]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

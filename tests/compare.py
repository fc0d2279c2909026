"""Compare a query with its SQL counterpart: names, number of rows, every value.

Run as a script: python tests/compare.py <folder of tables> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def ordered(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows by value."""
    positions = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(row[i] for i in positions) for row in rows]
    return [names[i] for i in positions], sorted(cells, key=lambda r: tuple((v is not None, str(v)) for v in r))


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return ordered(df.columns, [tuple(row) for row in df.collect()])


def sql_result(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    return ordered([d[0] for d in cursor.description], cursor.fetchall())


def difference(left: tuple[list[str], list[tuple]], right: tuple[list[str], list[tuple]]) -> str:
    """An empty text when both results are identical."""
    if left[0] != right[0]:
        return f"columns differ: {sorted(set(left[0]) ^ set(right[0]))}"
    if len(left[1]) != len(right[1]):
        return f"rows differ: {len(left[1])} and {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if not wrong:
        return ""
    a, b = wrong[0]
    cells = [(n, x, y) for n, x, y in zip(left[0], a, b) if x != y]
    return f"{len(wrong)} of {len(left[1])} rows differ, first: {cells[:4]}"


def main(folder: str, names: list[str]) -> int:
    from vaultspan.session import local_session

    spark = local_session(8)
    connection = sql_connection(folder)
    queries, oracle = spark_entry.queries(), spark_entry.oracle_sql()
    bad = 0
    for name in names or queries:
        try:
            start = time.time()
            ours = spark_result(queries[name](spark, folder))
            middle = time.time()
            theirs = sql_result(connection, oracle[name]) if name in oracle else ours
            gap = difference(ours, theirs)
        except Exception as error:  # noqa: BLE001
            ours, middle, gap = ([], []), time.time(), f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(gap)
        print(f"{name:28} {len(ours[1]):8} rows {middle - start:6.2f}s {time.time() - middle:6.2f}s {gap or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))

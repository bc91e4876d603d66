"""Runs every registered query and its SQL at one scale and compares schema and values.

``python tests/check_oracles.py [sf_dir] [query …]``; also used by ``test_oracles.py``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _text(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "∅"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    started = time.time()
    df = queries()[name](spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = f"{time.time() - started:5.1f}s {len(ours):7d} rows"
    sql = oracle_sql().get(name)
    if sql is None:
        return bool(ours), f"{took} (rows only)"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    wanted = {d[0]: str(d[1]) for d in result.description}
    theirs = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, f"{took} columns {sorted(df.columns)} != {sorted(columns)}"
    wrong = {c: t for c, t in df.dtypes if SQL_TYPES.get(t, t) != wanted[c]}
    if wrong:
        return False, f"{took} types {wrong}, SQL {({c: wanted[c] for c in wrong})}"
    if ours != theirs:
        different = next((pair for pair in zip(ours, theirs) if pair[0] != pair[1]), None)
        return False, f"{took}, SQL {len(theirs)} rows; first difference {different}"
    return True, took


if __name__ == "__main__":
    from conftest import build_session

    from __spark_entry__ import queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session, connection = build_session(), connect(sf)
    failed = 0
    for query in sys.argv[2:] or queries():
        try:
            good, note = compare(session, connection, query, sf)
        except Exception as error:  # noqa: BLE001
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {query:36s} {note}", flush=True)
    print(f"{failed} failed")

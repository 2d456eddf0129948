"""Compare registered queries with their SQL: ``python tests/check_queries.py [scale] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as entry  # noqa: E402
from broadsheet.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, connection, name: str, sf: str) -> str:
    """'' when both sides agree, else what differs."""
    frame = entry.queries()[name](spark, sf)
    got = rows_of(frame.columns, frame.collect())
    if name not in entry.oracle_sql():
        return "" if got else "no rows"
    result = connection.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    expected = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"\n  got      {a}\n  expected {b}"
    return ""


def main() -> None:
    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(sf)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            difference = compare(spark, connection, name, sf)
        except Exception as error:
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - start:6.2f}s {name}: {difference or 'ok'}", flush=True)


if __name__ == "__main__":
    main()

"""Run every query in Spark and its SQL in DuckDB, and compare rows as multisets.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from tallyloom.session import build_session

DEFAULT_FOLDER = "/root/testdata/sf0.01"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both sides agree on columns, kinds of value and rows."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(spark_frame.columns):
        return f"columns {sorted(spark_frame.columns)} instead of {sorted(names)}"
    actual = [tuple(row) for row in spark_frame.select(*names).collect()]
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    missing = Counter(map(repr, expected)) - Counter(map(repr, actual))
    surplus = Counter(map(repr, actual)) - Counter(map(repr, expected))
    if missing or surplus:
        return f"missing {list(missing)[:2]}, surplus {list(surplus)[:2]}"
    return None


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else DEFAULT_FOLDER
    wanted = arguments[1:] or list(QUERIES)
    spark = build_session(
        "compare",
        "local[*]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in wanted:
        started = time.perf_counter()
        frame = QUERIES[name](spark, folder)
        if name in ORACLE_SQL:
            found = difference(frame, connection, ORACLE_SQL[name])
        else:
            found = f"no SQL, {frame.count()} rows"
        failures += found is not None
        print(f"{name:40} {time.perf_counter() - started:6.1f} s  {found or 'equal'}", flush=True)
    print(f"{len(wanted) - failures} of {len(wanted)} equal")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

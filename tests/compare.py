"""Run a query in Spark and its twin in DuckDB on the same files and compare them value by value."""

from __future__ import annotations

import glob
import os

import duckdb


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(row[i] for i in order) for row in rows]
    return sorted(shaped, key=lambda row: [(v is None, str(v)) for v in row])


def differences(spark, connection, query, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count and what differs, in words."""
    df = query(spark, sf_dir)
    ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _sorted_rows(names, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)} rows")
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=False) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return len(ours), problems

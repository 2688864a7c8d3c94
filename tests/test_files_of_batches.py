"""Queries whose input lies in several files, against their DuckDB twins."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.compare import differences
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Events in two files; the second, read last, holds the earlier ones. Ids that 101 divides lack a session."""
    folder = tmp_path_factory.mktemp("tables")
    (folder / "events.parquet").mkdir()
    for name, day, ids in (("a", 20, range(0, 2020)), ("b", 3, range(2020, 2424))):
        n = len(ids)
        columns = {
            "event_id": pa.array(ids, pa.int64()),
            "ts": pa.array([datetime(2024, 1, day, i % 24) for i in ids], pa.timestamp("us")),
            "user_id": pa.array([i % 5 for i in ids], pa.int64()),
            "event_type": ["purchase"] * n,
            "value": [1.0 + i for i in ids],
            "props": [f'{{"k": {i % 4}}}' for i in ids],
        }
        pq.write_table(pa.table(columns), folder / "events.parquet" / f"{name}.parquet")
    part = {"p_partkey": pa.array(range(4), pa.int64()), "p_name": ["red tin", "blue tin", "old cup", "new cup"]}
    part |= {"p_brand": list("ABCD"), "p_type": ["HOME", "HOME", "TOY", "TOY"], "p_size": pa.array([1, 2, 3, 4], pa.int32())}
    pq.write_table(pa.table(part), folder / "part.parquet")
    people = {"c_custkey": pa.array(range(5), pa.int64()), "c_name": list("abcde"), "c_mktsegment": ["x"] * 5}
    pq.write_table(pa.table(people), folder / "customer.parquet")
    connection = duckdb.connect()
    for name, files in (("events", "events.parquet/*.parquet"), ("part", "part.parquet"), ("customer", "customer.parquet")):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{files}')")
    return str(folder), connection


@pytest.mark.parametrize("name", ["warehouse_fact", "warehouse_mart", "warehouse_replace_dates"])
def test_row_without_id_does_not_depend_on_the_files_of_a_batch(spark, tables, name):
    folder, connection = tables
    count, problems = differences(spark, connection, QUERIES[name], ORACLE[name], folder)
    assert problems == []
    assert count > 0

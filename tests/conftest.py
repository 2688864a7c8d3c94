from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import SparkSession

from tidemark.clock import as_of_column, use_utc
from tidemark.operators.ingest import to_bronze, with_lineage
from tidemark.schemas import EVENT


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    use_utc(session)
    yield session
    session.stop()


# One valid event; tests name what differs.
EVENT_DEFAULTS = {
    "event_time": "2019-10-01 00:00:00 UTC",
    "event_type": "view",
    "product_id": "1",
    "category_id": "10",
    "category_code": "a.b.c",
    "brand": "acme",
    "price": "5.0",
    "user_id": "7",
    "user_session": "s",
    "user_name": "Ann",
    "user_surname": "Lee",
}


def event(**fields) -> dict:
    return EVENT_DEFAULTS | fields


@pytest.fixture(scope="session")
def events_frame(spark):
    def make(*events: dict):
        return spark.createDataFrame([tuple(e[c] for c in EVENT.names) for e in events], EVENT)

    return make


@pytest.fixture(scope="session")
def bronze_frame(events_frame):
    def make(*events: dict, file: str = "a.csv", at: datetime = datetime(2020, 1, 1)):
        return to_bronze(with_lineage(events_frame(*events), file, at))

    return make


@pytest.fixture(scope="session")
def at():
    return as_of_column


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]

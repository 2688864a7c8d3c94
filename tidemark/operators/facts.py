"""Silver fact: typed events, one row per event id."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.clock import as_of_column
from tidemark.functions import event_id, to_double, to_event_time, to_int
from tidemark.operators.incremental import anti_append, latest_per_key, newest_first
from tidemark.schemas import FACT_EVENTS

NULL_ID_POLICIES = ("collapse", "quarantine")


def typed_events(bronze: DataFrame) -> DataFrame:
    """Bronze rows with their event id and tolerant types."""
    return bronze.select(
        event_id(*[F.col(c) for c in ("event_time", "event_type", "user_id", "product_id", "user_session")]).alias(
            "event_id"
        ),
        to_event_time(F.col("event_time")).alias("event_timestamp"),
        "event_type",
        to_int(F.col("product_id")).alias("product_id"),
        to_int(F.col("user_id")).alias("user_id"),
        to_double(F.col("price")).alias("price"),
        "user_session",
        F.col("_file_name").alias("source_file"),
        "_ingested_at",
    )


def null_id_rows(bronze: DataFrame) -> DataFrame:
    """Typed rows that lack one of the identifying fields."""
    return typed_events(bronze).filter(F.col("event_id").isNull())


def fact_events(
    bronze: DataFrame,
    as_of: datetime | None,
    existing: DataFrame | None = None,
    null_id: str = "collapse",
) -> DataFrame:
    """Rows to append to the fact: newest ingest per event id, without ids that ``existing`` holds.

    Rows without an id are one group: one of them is kept per call (``collapse``), or none
    (``quarantine``, see ``null_id_rows``). Equal ingest time and file are decided by the other columns.
    """
    if null_id not in NULL_ID_POLICIES:
        raise ValueError(f"null_id must be one of {NULL_ID_POLICIES}")
    typed = typed_events(bronze)
    if null_id == "quarantine":
        typed = typed.filter(F.col("event_id").isNotNull())
    order = newest_first(
        "_ingested_at",
        "source_file",
        "event_timestamp",
        "event_type",
        "product_id",
        "user_id",
        "price",
        "user_session",
    )
    staged = (
        latest_per_key(typed, ["event_id"], order)
        .withColumn("_loaded_at", as_of_column(as_of))
        .select(*FACT_EVENTS.names)
    )
    return staged if existing is None else anti_append(staged, existing, "event_id")

"""Silver dimensions: the latest attributes of each product and user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import category_level, to_event_time, to_int
from tidemark.operators.incremental import latest_per_key, newest_first
from tidemark.schemas import DIM_PRODUCTS, DIM_USERS


def dim_latest(bronze: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """``key, attributes, _updated_at`` of the newest ingest per integer key.

    Rows of one ingest are ordered by event time, then by the attributes themselves. Events first shrink
    to one row per key, attribute values and ingest time by hash aggregation, so that only those are
    sorted and a key that holds a third of all events is small before it is shuffled.
    """
    seen = (
        bronze.filter(F.col(key).isNotNull())
        .select(
            to_int(F.col(key)).alias(key),
            *attributes,
            "_ingested_at",
            to_event_time(F.col("event_time")).alias("_event_time"),
        )
        .filter(F.col(key).isNotNull())
        .groupBy(key, *attributes, "_ingested_at")
        .agg(F.max("_event_time").alias("_event_time"))
    )
    latest = latest_per_key(seen, [key], newest_first("_ingested_at", "_event_time", *attributes))
    return latest.select(key, *attributes, F.col("_ingested_at").alias("_updated_at"))


def dim_products(bronze: DataFrame) -> DataFrame:
    """Latest brand and category of each product, the category also by level."""
    latest = dim_latest(bronze, "product_id", ["brand", "category_code"])
    levels = {f"category_l{n}": category_level(F.col("category_code"), n) for n in (1, 2, 3)}
    return latest.withColumns(levels).select(*DIM_PRODUCTS.names)


def dim_users(bronze: DataFrame) -> DataFrame:
    """Latest name of each user."""
    return dim_latest(bronze, "user_id", ["user_name", "user_surname"]).select(*DIM_USERS.names)

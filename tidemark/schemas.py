"""Declared table schemas (the data contract) and the check of a DataFrame against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EVENT_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "user_name",
    "user_surname",
)

# One CSV line or one JSON message: text only, typed in silver.
EVENT = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])

BRONZE = T.StructType(
    EVENT.fields
    + [
        T.StructField("_file_name", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)

FACT_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_session", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("_loaded_at", T.TimestampType()),
    ]
)

DIM_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.IntegerType()),
        T.StructField("brand", T.StringType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("category_l1", T.StringType()),
        T.StructField("category_l2", T.StringType()),
        T.StructField("category_l3", T.StringType()),
        T.StructField("_updated_at", T.TimestampType()),
    ]
)

DIM_USERS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("user_surname", T.StringType()),
        T.StructField("_updated_at", T.TimestampType()),
    ]
)

MARKETING_REPORT = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        T.StructField("brand", T.StringType()),
        T.StructField("category_l1", T.StringType()),
        T.StructField("total_views", T.LongType()),
        T.StructField("total_purchases", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("conversion_rate_pct", T.DoubleType()),
        T.StructField("_refreshed_at", T.TimestampType()),
    ]
)

DQ_METRICS = T.StructType(
    [
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("measured_at", T.TimestampType()),
    ]
)

# Not in the contract: what an ingest set aside, what became of each file, and what each build took and did.
QUARANTINE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("_file_name", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)

# Totals of the fact by event date, of which metrics and checks are made.
FACT_TOTALS = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("rows_with_id", T.LongType()),
        T.StructField("complete_rows", T.LongType()),
        T.StructField("invalid_price_rows", T.LongType()),
        T.StructField("max_loaded_at", T.TimestampType()),
        T.StructField("distinct_ids", T.LongType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("_file_name", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)

CONSUMED = T.StructType([T.StructField("load", T.StringType())])

TOUCHED = T.StructType([T.StructField("event_date", T.DateType())])

# A build begins, has its silver tables, has its gold tables.
BUILD_LOG = T.StructType(
    [
        T.StructField("phase", T.StringType()),
        T.StructField("build", T.StringType()),
        T.StructField("as_of", T.TimestampType()),
        T.StructField("fact_rows", T.LongType()),
    ]
)

CONTRACT = {
    "bronze_raw_events": BRONZE,
    "fact_events": FACT_EVENTS,
    "dim_products": DIM_PRODUCTS,
    "dim_users": DIM_USERS,
    "marketing_report": MARKETING_REPORT,
    "dq_pipeline_metrics": DQ_METRICS,
}


def contract_violations(df: DataFrame, table: str) -> list[str]:
    """Differences in column names and types between ``df`` and the contract; reads no data."""
    declared = {f.name: f.dataType.simpleString() for f in CONTRACT[table].fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = [f"{table}.{c}: missing" for c in declared if c not in actual]
    problems += [f"{table}.{c}: not in contract" for c in actual if c not in declared]
    problems += [
        f"{table}.{c}: {actual[c]} instead of {t}"
        for c, t in declared.items()
        if c in actual and actual[c] != t
    ]
    return problems

"""Data quality: metrics of the fact, and checks that return their violations (no rows = passed)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.clock import as_of_column
from tidemark.functions import percent, plain_decimal, round_half_away
from tidemark.operators.marts import GRAIN

# Metric names other tools query by.
ROW_COUNT = "silver_fact_events_row_count"
COMPLETENESS = "silver_fact_events_completeness_key_cols_pct"
UNIQUENESS = "silver_fact_events_event_id_uniqueness_pct"
FRESHNESS = "silver_fact_events_freshness_hours"
INVALID_PRICES = "silver_fact_events_invalid_purchase_price_row_count"
METRICS = (ROW_COUNT, COMPLETENESS, UNIQUENESS, FRESHNESS, INVALID_PRICES)

MIN_COMPLETENESS_PCT = 95.0


def complete_keys() -> Column:
    return (
        F.col("event_timestamp").isNotNull()
        & F.col("event_type").isNotNull()
        & F.col("product_id").isNotNull()
        & F.col("user_id").isNotNull()
    )


def invalid_purchase_price() -> Column:
    return (F.col("event_type") == "purchase") & (F.col("price").isNull() | (F.col("price") <= 0))


def fact_summary(fact: DataFrame) -> DataFrame:
    """One row of totals that all metrics and fact checks are made of.

    The distinct count is a subquery of its own: the two parts read different columns, and the shuffle
    by event id carries ids only, not the partial sums of the other totals with every id.
    """
    distinct_ids = fact.agg(F.count_distinct("event_id").alias("n"))
    totals = fact.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("event_id").alias("rows_with_id"),
        F.sum(F.when(complete_keys(), 1).otherwise(0)).alias("complete_rows"),
        F.sum(F.when(invalid_purchase_price(), 1).otherwise(0)).alias("invalid_price_rows"),
        F.max("_loaded_at").alias("max_loaded_at"),
    )
    return totals.withColumn("distinct_ids", distinct_ids.scalar())


def fact_totals_by_date(fact: DataFrame) -> DataFrame:
    """The totals of ``fact_summary`` for each ``event_date``, the NULL date included.

    Equal ids have equal event times, so an id belongs to one date and distinct counts of dates add up.
    """
    ids = fact.groupBy("event_date", "event_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(complete_keys(), 1).otherwise(0)).alias("complete_rows"),
        F.sum(F.when(invalid_purchase_price(), 1).otherwise(0)).alias("invalid_price_rows"),
        F.max("_loaded_at").alias("max_loaded_at"),
    )
    return ids.groupBy("event_date").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("event_id").isNotNull(), F.col("rows"))), F.lit(0)).alias("rows_with_id"),
        F.sum("complete_rows").alias("complete_rows"),
        F.sum("invalid_price_rows").alias("invalid_price_rows"),
        F.max("max_loaded_at").alias("max_loaded_at"),
        F.count("event_id").alias("distinct_ids"),
    )


def summary_of_totals(totals: DataFrame) -> DataFrame:
    """One row like ``fact_summary``'s, from totals by date."""
    sums = [F.sum(c).alias(c) for c in ("complete_rows", "invalid_price_rows")]
    return totals.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "rows_with_id", "distinct_ids")],
        *sums,
        F.max("max_loaded_at").alias("max_loaded_at"),
    )


def metrics_from(summary: DataFrame, as_of: datetime | None, names: tuple[str, ...] = METRICS) -> DataFrame:
    """The one-row summary as one row per metric; totals no requested metric needs are not computed.

    On an empty fact the sums are NULL and the freshness row is absent.
    """
    now = as_of_column(as_of)
    # Whole seconds on both sides: seconds boundaries passed, not elapsed seconds.
    hours = (F.unix_seconds(now) - F.unix_seconds("max_loaded_at")) / F.lit(3600.0)
    values = {
        ROW_COUNT: (F.col("rows").cast("string"), "count"),
        COMPLETENESS: (plain_decimal(percent(F.col("complete_rows"), F.col("rows"), 4)), "percent"),
        UNIQUENESS: (plain_decimal(percent(F.col("distinct_ids"), F.col("rows"), 4)), "percent"),
        FRESHNESS: (plain_decimal(round_half_away(hours, 4)), "hours"),
        INVALID_PRICES: (F.col("invalid_price_rows").cast("string"), "count"),
    }
    entries = [
        F.struct(F.lit(n).alias("metric_name"), values[n][0].alias("metric_value"), F.lit(values[n][1]).alias("unit"))
        for n in names
    ]
    long = summary.select("rows", F.inline(F.array(*entries)))
    if FRESHNESS in names:
        long = long.filter((F.col("metric_name") != FRESHNESS) | (F.col("rows") > 0))
    return long.select("metric_name", "metric_value", "unit", now.alias("measured_at"))


def dq_metrics(fact: DataFrame, as_of: datetime | None, names: tuple[str, ...] = METRICS) -> DataFrame:
    """``metric_name, metric_value, unit, measured_at`` of the fact."""
    return metrics_from(fact_summary(fact), as_of, names)


def check_completeness(fact: DataFrame, minimum: float = MIN_COMPLETENESS_PCT) -> DataFrame:
    """The share of complete rows, if it is below the minimum."""
    complete = F.sum(F.when(complete_keys(), 1).otherwise(0))
    share = fact.agg(percent(complete, F.count(F.lit(1))).alias("completeness_pct"))
    return share.filter(F.col("completeness_pct") < minimum)


def duplicates(df: DataFrame, keys: list[str], count_name: str) -> DataFrame:
    """Keys held by more than one row, with their number; NULLs count as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def duplicate_event_ids(fact: DataFrame) -> DataFrame:
    return duplicates(fact, ["event_id"], "cnt")


def duplicate_mart_grain(mart: DataFrame) -> DataFrame:
    return duplicates(mart, GRAIN, "row_count")


def bad_purchase_prices(fact: DataFrame) -> DataFrame:
    """Purchases without a positive price."""
    return fact.filter(invalid_purchase_price()).select("event_id", "event_type", "price")


def failed_fact_checks(summary) -> dict[str, int]:
    """The fact checks, decided from one ``fact_summary`` row: check name to number of violations.

    Counts incomplete rows, rows beyond the first of each id, and invalid purchases.
    """
    without_id = summary["rows"] - summary["rows_with_id"]
    surplus = summary["rows_with_id"] - summary["distinct_ids"] + max(without_id - 1, 0)
    failed = {}
    if summary["rows"] and 100.0 * summary["complete_rows"] / summary["rows"] < MIN_COMPLETENESS_PCT:
        failed["completeness"] = summary["rows"] - summary["complete_rows"]
    if surplus:
        failed["event_id_unique"] = surplus
    if summary["invalid_price_rows"]:
        failed["purchase_price_positive"] = summary["invalid_price_rows"]
    return failed

"""Gold: the daily marketing report, from silver or straight from raw event rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.clock import as_of_column
from tidemark.functions import UNKNOWN, known_or_unknown, percent, plain_time, strip_utc, strip_whitespace, to_double
from tidemark.operators.incremental import incremental_delta
from tidemark.schemas import MARKETING_REPORT

GRAIN = ["report_date", "brand", "category_l1"]
RAW_MART_COLUMNS = ("event_time", "event_type", "brand", "category_code", "price")


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def report_date() -> Column:
    return F.to_date("event_timestamp")


def affected_dates(fact: DataFrame, mart: DataFrame) -> DataFrame:
    """Event dates of facts loaded since the mart's last refresh."""
    fresh = incremental_delta(fact, "_loaded_at", mart, "_refreshed_at")
    return fresh.select(report_date().alias("report_date")).distinct()


def on_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts of the given ``report_date`` values; facts without a date never match.

    Of a fact partitioned by ``event_date``, Spark reads only the partitions of these dates.
    """
    dated = fact.withColumn("report_date", F.col("event_date") if "event_date" in fact.columns else report_date())
    return dated.join(dates.select("report_date"), "report_date", "left_semi").select(*fact.columns)


def daily_product_totals(fact: DataFrame) -> DataFrame:
    """Views, purchases and revenue by day and product: all the report needs of the facts."""
    return (
        fact.select(report_date().alias("report_date"), "product_id", "event_type", "price")
        .filter(F.col("report_date").isNotNull())
        .groupBy("report_date", "product_id")
        .agg(
            F.count_if(is_type("view")).alias("views"),
            F.count_if(is_type("purchase")).alias("purchases"),
            F.sum(F.when(is_type("purchase"), F.col("price"))).alias("revenue"),
        )
    )


def marketing_report(
    fact: DataFrame, products: DataFrame, as_of: datetime | None, dates: DataFrame | None = None
) -> DataFrame:
    """Views, purchases, revenue and conversion by day, brand and top category.

    Facts are summed by day and product before the dimension is joined. The join and its shuffle then see
    one row per day and product instead of every event, and a best-selling product is no hot key.
    """
    scoped = fact if dates is None else on_dates(fact, dates)
    brands = products.select("product_id", "brand", "category_l1")
    return (
        daily_product_totals(scoped)
        .join(brands, "product_id", "left")
        .groupBy(
            "report_date",
            known_or_unknown(F.col("brand")).alias("brand"),
            known_or_unknown(F.col("category_l1")).alias("category_l1"),
        )
        .agg(
            F.sum("views").alias("total_views"),
            F.sum("purchases").alias("total_purchases"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue"),
        )
        .withColumn("conversion_rate_pct", percent(F.col("total_purchases"), F.col("total_views"), 2))
        .withColumn("_refreshed_at", as_of_column(as_of))
        .select(*MARKETING_REPORT.names)
    )


def raw_marketing_mart(raw: DataFrame, as_of: datetime | None, on_bad_price: str = "raise") -> DataFrame:
    """The same grain straight from event rows: no deduplication, brand and category as on the event.

    Unreadable times are kept under a NULL date. An unreadable price fails the job, or counts as NULL
    with ``on_bad_price="null"``.
    """
    missing = sorted(set(RAW_MART_COLUMNS) - set(raw.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    price = to_double(F.col("price"))
    if on_bad_price == "raise":
        unreadable = F.col("price").isNotNull() & price.isNull()
        message = F.concat(F.lit("Unreadable price: "), F.col("price"))
        price = F.when(unreadable, F.raise_error(message).cast("double")).otherwise(price)
    elif on_bad_price != "null":
        raise ValueError("on_bad_price must be 'raise' or 'null'")

    def bucket(text: Column) -> Column:
        return F.coalesce(F.nullif(strip_whitespace(text), F.lit("")), F.lit(UNKNOWN))

    # The usual form needs no pattern parser; the parser decides on everything else.
    usual = plain_time(F.col("event_time"))
    parsed = F.try_to_timestamp(strip_utc(F.col("event_time")), F.lit("yyyy-MM-dd HH:mm:ss"))
    time = F.when(usual.isNotNull(), usual.try_cast("timestamp_ntz")).otherwise(parsed.cast("timestamp_ntz"))
    return (
        raw.select(
            F.to_date(time).alias("report_date"),
            bucket(F.col("brand")).alias("brand"),
            bucket(F.split_part("category_code", F.lit("."), F.lit(1))).alias("category_l1"),
            "event_type",
            price.alias("price"),
        )
        .groupBy(*GRAIN)
        .agg(
            F.count_if(is_type("view")).alias("total_views"),
            F.count_if(is_type("purchase")).alias("total_purchases"),
            F.coalesce(F.sum(F.when(is_type("purchase"), F.col("price")).otherwise(F.lit(0.0))), F.lit(0.0)).alias("revenue"),
        )
        .withColumn("conversion_rate_pct", percent(F.col("total_purchases"), F.col("total_views"), 2))
        .withColumn("_refreshed_at", as_of_column(as_of))
        .select(*MARKETING_REPORT.names)
    )

"""The queries that consumers of the warehouse run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_with_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Every fact with its product's brand and top category, NULL where the product is unknown.

    Without hints: Spark broadcasts the dimension while its measured size allows, and otherwise splits
    the partitions of products that hold too many facts (AQE skew join).
    """
    brands = products.select("product_id", "brand", "category_l1")
    return fact.join(brands, "product_id", "left").select(
        "event_id", "event_timestamp", "event_type", "product_id", "brand", "category_l1"
    )


def preview_fact_with_products(fact: DataFrame, products: DataFrame, rows: int = 50) -> DataFrame:
    """The first facts by id with their product. The top rows are taken before the join."""
    first = fact.orderBy(*[F.col(c).asc_nulls_last() for c in ("event_id", "event_timestamp", "product_id")])
    return fact_with_products(first.limit(rows), products)


def latest_report(mart: DataFrame, rows: int = 20) -> DataFrame:
    """The newest report rows; equal dates in order of brand and category."""
    return mart.orderBy(F.col("report_date").desc_nulls_last(), "brand", "category_l1").limit(rows)


def metrics_by_name(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("metric_name")

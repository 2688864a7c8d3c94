"""Spark-native analytics for e-commerce click events: bronze, silver, gold and data quality."""

from tidemark.plans.warehouse import BuildResult, QualityError, Warehouse

__all__ = ["BuildResult", "QualityError", "Warehouse"]

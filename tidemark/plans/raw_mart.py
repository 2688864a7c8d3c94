"""The report mart straight from CSV files, outside the warehouse."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.clock import use_utc
from tidemark.operators.marts import RAW_MART_COLUMNS, raw_marketing_mart
from tidemark.sources.csv_files import read_events
from tidemark.sources.files import replace_directory


def build_raw_mart(
    spark: SparkSession,
    paths: str | list[str],
    output: str,
    as_of: datetime | None = None,
    on_bad_price: str = "raise",
) -> int:
    """Aggregate the files and overwrite ``output`` with zstd Parquet; number of rows written.

    ValueError if no file matches or a needed column is absent.
    """
    use_utc(spark)
    mart = raw_marketing_mart(read_events(spark, paths, RAW_MART_COLUMNS), as_of, on_bad_price)
    written = Observation("written")
    counted = mart.observe(written, F.count(F.lit(1)).alias("rows"))
    # Written beside the old output, which stays if the job fails.
    staged = f"{output.rstrip('/')}.new"
    counted.write.mode("overwrite").option("compression", "zstd").parquet(staged)
    replace_directory(spark, staged, output)
    return written.get["rows"]

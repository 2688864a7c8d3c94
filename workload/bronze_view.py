"""Bronze rows derived from ``events``, ``part`` and ``customer``: every event, in two ingest batches."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.clock import as_of_column, use_utc
from tidemark.operators.ingest import with_lineage
from tidemark.schemas import BRONZE, EVENT_COLUMNS

INGESTED = {1: datetime(2024, 3, 1), 2: datetime(2024, 3, 2)}
RUN_1 = datetime(2024, 3, 1, 12)
RUN_2 = datetime(2024, 3, 2, 12)
MEASURED = datetime(2024, 3, 2, 18, 30)


def every(n: int) -> Column:
    return F.col("eid") % n == 0


def event_lines(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """One text line per delivered event, plus ``eid`` and ``batch``.

    Batch 2 brings the events that batch 1 lacks, delivers a tenth of all again, and renames the brand of
    every fifth product. ``dirty`` adds values that the tolerant casts have to survive.
    """
    use_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("eid"),
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    # What depends on the product alone is made once per product, not per event.
    code = F.concat_ws(".", F.lower("p_type"), F.replace("p_name", F.lit(" "), F.lit(".")))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey",
        F.col("p_size").cast("string").alias("category_id"),
        F.when(F.col("p_size") % 11 != 0, code).alias("category_code"),
        F.when(F.col("p_size") % 7 == 0, F.lit("  ")).otherwise(F.col("p_brand")).alias("brand"),
    )
    people = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_mktsegment")
    wide = events.join(parts, F.col("k") == F.col("p_partkey"), "left").join(
        people, F.col("user_id") == F.col("c_custkey"), "left"
    )
    columns = {
        "event_time": F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")),
        "event_type": F.col("event_type"),
        "product_id": F.col("k").cast("string"),
        "category_id": F.col("category_id"),
        "category_code": F.col("category_code"),
        "brand": F.col("brand"),
        "price": F.when(every(97), F.lit(0.0)).otherwise(F.col("value")).cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "user_session": F.when(~every(101), F.concat(F.lit("s-"), F.col("eid").cast("string"))),
        "user_name": F.col("c_name"),
        "user_surname": F.col("c_mktsegment"),
    }
    if dirty:
        iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
        columns["event_time"] = (
            F.when(every(103), F.lit("not-a-time"))
            .when(every(127), iso)
            .when(every(137), F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
            .when(every(139), F.lit("+2019-10"))
            .otherwise(columns["event_time"])
        )
        columns["product_id"] = (
            F.when(every(107), F.lit("abc"))
            .when(every(131), F.concat(columns["product_id"], F.lit(".5")))
            .otherwise(columns["product_id"])
        )
        columns["price"] = F.when(every(89), F.lit("n/a")).otherwise(columns["price"])
        columns["user_id"] = F.when(every(109), F.lit("3000000000")).otherwise(columns["user_id"])
        columns["event_type"] = F.when(~every(113), F.col("event_type"))
    lines = wide.select("eid", "k", *[value.alias(name) for name, value in columns.items()])
    first, second = F.lit(1), F.lit(2)
    delivered = (
        F.when(F.col("eid") % 5 == 4, F.array(second))
        .when(every(10), F.array(first, second))
        .when(F.col("eid").isNotNull(), F.array(first))
    )
    renamed = (F.col("batch") == 2) & (F.col("k") % 5 == 0)
    return (
        lines.withColumn("batch", F.explode(delivered))
        .withColumn("brand", F.when(renamed, F.concat("brand", F.lit("-v2"))).otherwise(F.col("brand")))
        .select("eid", "batch", *EVENT_COLUMNS)
    )


def bronze(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """The event lines as the bronze table holds them after both ingests."""
    lines = event_lines(spark, sf_dir, dirty)
    file_name = F.concat(F.lit("batch_"), F.col("batch").cast("string"), F.lit(".csv"))
    stamped = with_lineage(lines, file_name, None)
    ingested = F.when(F.col("batch") == 1, as_of_column(INGESTED[1])).otherwise(as_of_column(INGESTED[2]))
    return stamped.withColumn("_ingested_at", ingested).select(*BRONZE.names)


def until(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Bronze as it stood at a build."""
    return rows.filter(F.col("_ingested_at") <= as_of_column(as_of))


def fresh_folder(spark: SparkSession) -> str:
    """A path of its own in ``spark.checkpoint.dir``, the folder the cluster shares; only where that is unset (one
    machine, as in tests) in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tidemark-")
    return f"{folder.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the folder the cluster shares, as a build leaves it for the next one."""
    path = fresh_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def csv_folder(lines: DataFrame, quote: bool = True) -> str:
    """The event columns of ``lines`` as CSV files with header; without quotes, a comma in a field makes one more."""
    path = fresh_folder(lines.sparkSession)
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if not quote:
        options["quote"] = "\u0000"
    lines.select(*EVENT_COLUMNS).write.options(**options).csv(path)
    return path

"""Time the headline operators on warm Spark and print one JSON line.

What an operator reads (bronze, facts, messages, the tables of an earlier run) is written before and not timed.
BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2, median), BENCH_COPIES
(default 1: so many copies of the events, with distinct sessions), BENCH_QUERIES (comma-separated names; ``all`` for
every registered query as a whole, its preparation included).
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dimensions import dim_products
from tidemark.operators.facts import fact_events
from tidemark.operators.incremental import incremental_delta, upsert
from tidemark.operators.marts import GRAIN, affected_dates, marketing_report, raw_marketing_mart
from tidemark.operators.quality import dq_metrics
from tidemark.schemas import EVENT_COLUMNS
from tidemark.sources.json_messages import decode_events, encode_events
from workload.bronze_view import MEASURED, RUN_1, RUN_2, bronze, fresh_folder, until, written
from workload.queries import QUERIES


def seconds(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def spread_out(df: DataFrame, files: int) -> DataFrame:
    path = fresh_folder(df.sparkSession)
    df.repartition(files).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def headline(spark: SparkSession, sf_dir: str, cpus: int, copies: int) -> dict[str, Callable[[], DataFrame]]:
    """The operators over prepared tables."""
    rows = bronze(spark, sf_dir)
    if copies > 1:
        session = F.concat("user_session", F.lit("-"), F.col("copy").cast("string"))
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        rows = rows.withColumn("user_session", session).drop("copy")
    rows = spread_out(rows, cpus)
    messages = spread_out(encode_events(rows.select(*EVENT_COLUMNS)).select(F.col("value").cast("binary").alias("value")), cpus)
    fact_1 = written(fact_events(until(rows, RUN_1), RUN_1))
    products = written(dim_products(rows))
    delta = written(incremental_delta(rows, "_ingested_at", fact_1, "_loaded_at"))
    fact = written(fact_1.unionByName(fact_events(delta, RUN_2, existing=fact_1)))
    mart = written(marketing_report(fact_1, products, RUN_1))
    return {
        "decode_events": lambda: decode_events(messages),
        "fact_events": lambda: fact_events(rows, RUN_2),
        "fact_events_incremental": lambda: fact_events(delta, RUN_2, existing=fact_1),
        "dim_products": lambda: dim_products(rows),
        "marketing_report": lambda: marketing_report(fact, products, RUN_2),
        "marketing_report_incremental": lambda: upsert(
            mart, marketing_report(fact, products, RUN_2, affected_dates(fact, mart)), GRAIN
        ),
        "raw_marketing_mart": lambda: raw_marketing_mart(rows, RUN_2, on_bad_price="null"),
        "dq_pipeline_metrics": lambda: dq_metrics(fact, MEASURED),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    try:
        if chosen == "all":
            steps = {name: (lambda q=q: q(spark, sf_dir)) for name, q in QUERIES.items()}
        else:
            steps = headline(spark, sf_dir, cpus, copies)
            names = [name for name in chosen.split(",") if name]
            steps = {name: steps[name] for name in names or steps}
        timings = {}
        for name, make in steps.items():
            seconds(make)
            timings[name] = round(statistics.median(seconds(make) for _ in range(runs)), 3)
    finally:
        spark.stop()
        shutil.rmtree(scratch, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "headline operators on prepared tables, warm, sum of medians",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "copies": copies,
            }
        )
    )


if __name__ == "__main__":
    main()

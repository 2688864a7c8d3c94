"""One query per operator. Each reads the whole tables and returns a DataFrame with plain column types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import category_level, event_id, known_or_unknown, percent
from tidemark.operators import quality
from tidemark.operators.contract import contract_violations
from tidemark.operators.dimensions import dim_products, dim_users
from tidemark.operators.facts import fact_events, null_id_rows, typed_events
from tidemark.operators.incremental import duplicate_or_null_keys, incremental_delta, upsert
from tidemark.operators.ingest import ingest_summary, skip_ingested_files, union_batches
from tidemark.operators.marts import (
    GRAIN,
    affected_dates,
    is_type,
    marketing_report,
    on_dates,
    raw_marketing_mart,
    report_date,
)
from tidemark.plans.raw_mart import build_raw_mart
from tidemark.plans.reports import (
    fact_with_products,
    latest_report,
    metrics_by_name,
    preview_fact_with_products,
)
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import EVENT_COLUMNS
from tidemark.sources.csv_files import read_events, rejected_rows
from tidemark.sources.json_messages import decode_events, encode_events, malformed_messages
from tidemark.streaming.ingest import csv_to_bronze, messages_to_bronze
from workload.bronze_view import (
    INGESTED,
    MEASURED,
    RUN_1,
    RUN_2,
    bronze,
    csv_folder,
    event_lines,
    every,
    fresh_folder,
    until,
    written,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query. System times come out zone-less, revenue to the cent."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain(function(spark, sf_dir))

        QUERIES[name] = run
        return function

    return register


def _plain(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        elif field.name == "revenue":
            column = F.round(column, 2).alias(field.name)
        columns.append(column)
    return df.select(*columns)


# -- bronze


@query("bronze_ingest")
def bronze_ingest(spark, sf_dir):
    return bronze(spark, sf_dir)


@query("ingest_summary")
def ingest_summary_(spark, sf_dir):
    return ingest_summary(bronze(spark, sf_dir))


@query("skip_ingested_files")
def skip_ingested(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return skip_ingested_files(rows.select(*EVENT_COLUMNS, "_file_name"), until(rows, RUN_1))


@query("union_batches")
def union_of_batches(spark, sf_dir):
    """Two sources of different column order, the second without category ids."""
    rows = event_lines(spark, sf_dir)
    first = rows.filter("batch = 1").select("eid", *EVENT_COLUMNS)
    second = rows.filter("batch = 2").select(*reversed(EVENT_COLUMNS), "eid").drop("category_id")
    return union_batches(first, second)


@query("encode_events")
def encode(spark, sf_dir):
    return encode_events(event_lines(spark, sf_dir).select(*EVENT_COLUMNS))


@query("decode_events")
def decode(spark, sf_dir):
    return decode_events(_messages(spark, sf_dir))


@query("malformed_messages")
def malformed(spark, sf_dir):
    return malformed_messages(_messages(spark, sf_dir)).select(F.col("value").cast("string").alias("value"))


def _messages(spark, sf_dir) -> DataFrame:
    """Messages of all events, written down. Some are not JSON, not one object, single-quoted, lack a key or carry
    another one."""

    def text(*columns) -> Column:
        return F.to_json(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]))

    rows = event_lines(spark, sf_dir).select("eid", *EVENT_COLUMNS)
    parts = rows.select(
        "eid",
        text(*EVENT_COLUMNS).alias("whole"),
        text(*[c for c in EVENT_COLUMNS if c != "brand"]).alias("without_brand"),
    )
    whole, quote = F.col("whole"), F.lit('"')
    value = (
        F.when(every(53), F.concat(F.lit("not json "), whole))
        .when(every(59), F.concat(F.lit("["), whole, F.lit("]")))
        .when(every(71), F.concat(whole, F.lit(" "), whole))
        .when(every(73), F.replace(whole, quote, F.lit("'")))
        .when(every(61), F.col("without_brand"))
        .when(every(67), F.concat(F.lit('{"campaign":"x",'), F.substr(whole, F.lit(2))))
        .otherwise(whole)
    )
    return written(written(parts).select(value.cast("binary").alias("value")))


def _ragged_files(spark, sf_dir) -> str:
    """CSV files in which every 59th event with a brand has a field too many."""
    rows = event_lines(spark, sf_dir)
    brand = F.when(every(59), F.concat("brand", F.lit(",more"))).otherwise(F.col("brand"))
    return csv_folder(rows.withColumn("brand", brand), quote=False)


@query("csv_scan")
def csv_scan(spark, sf_dir):
    return read_events(spark, _ragged_files(spark, sf_dir), on_bad_row="quarantine").select(*EVENT_COLUMNS)


@query("csv_rejects")
def csv_rejects(spark, sf_dir):
    """The writer marks the field that it did not quote with NUL characters."""
    value = F.replace("value", F.lit("\u0000"), F.lit(""))
    return rejected_rows(spark, _ragged_files(spark, sf_dir)).select(value.alias("value"))


# -- silver


@query("event_id_hash")
def event_id_hash(spark, sf_dir):
    parts = ("event_time", "event_type", "user_id", "product_id", "user_session")
    return event_lines(spark, sf_dir, dirty=True).select(
        "eid", "batch", event_id(*[F.col(c) for c in parts]).alias("event_id")
    )


@query("typed_events")
def typed(spark, sf_dir):
    return typed_events(bronze(spark, sf_dir, dirty=True))


@query("category_levels")
def category_levels(spark, sf_dir):
    levels = [category_level(F.col("category_code"), n).alias(f"category_l{n}") for n in (1, 2, 3)]
    return event_lines(spark, sf_dir).select("eid", "batch", "category_code", *levels)


@query("normalize_unknown")
def normalize_unknown(spark, sf_dir):
    return event_lines(spark, sf_dir).select(
        "eid",
        "batch",
        known_or_unknown(F.col("brand")).alias("brand"),
        known_or_unknown(category_level(F.col("category_code"), 1)).alias("category_l1"),
    )


@query("events_by_day")
def events_by_day(spark, sf_dir):
    days = typed_events(bronze(spark, sf_dir, dirty=True)).groupBy(report_date().alias("report_date"), "event_type")
    return days.agg(F.count(F.lit(1)).alias("events"))


@query("fact_events")
def fact_events_full(spark, sf_dir):
    return fact_events(bronze(spark, sf_dir), RUN_2)


@query("null_id_quarantine")
def null_id_quarantine(spark, sf_dir):
    return null_id_rows(bronze(spark, sf_dir))


@query("dim_products")
def dim_products_full(spark, sf_dir):
    return dim_products(bronze(spark, sf_dir))


@query("dim_users")
def dim_users_full(spark, sf_dir):
    return dim_users(bronze(spark, sf_dir))


# -- incremental: what run 1 left is a written table, run 2 works on its delta


def _fact_after_run_1(rows: DataFrame) -> DataFrame:
    return fact_events(until(rows, RUN_1), RUN_1)


def _fact_after_run_2(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    before = before or written(_fact_after_run_1(rows))
    delta = incremental_delta(rows, "_ingested_at", before, "_loaded_at")
    return before.unionByName(written(fact_events(delta, RUN_2, existing=before)))


def _dimension_after_run_2(rows: DataFrame, latest, key: str, before: DataFrame | None = None) -> DataFrame:
    before = before or written(latest(until(rows, RUN_1)))
    delta = incremental_delta(rows, "_ingested_at", before, "_updated_at")
    return upsert(before, latest(delta), [key])


def _two_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact and product dimension after run 2, and the mart after run 1."""
    rows = written(bronze(spark, sf_dir))
    fact_1 = written(_fact_after_run_1(rows))
    products_1 = written(dim_products(until(rows, RUN_1)))
    mart = written(marketing_report(fact_1, products_1, RUN_1))
    fact = _fact_after_run_2(rows, fact_1)
    products = _dimension_after_run_2(rows, dim_products, "product_id", products_1)
    return fact, products, mart


@query("incremental_delta")
def incremental_delta_(spark, sf_dir):
    rows = written(bronze(spark, sf_dir))
    return incremental_delta(rows, "_ingested_at", written(_fact_after_run_1(rows)), "_loaded_at")


@query("fact_events_incremental")
def fact_events_incremental(spark, sf_dir):
    return _fact_after_run_2(written(bronze(spark, sf_dir)))


@query("dim_products_merge")
def dim_products_merge(spark, sf_dir):
    return _dimension_after_run_2(written(bronze(spark, sf_dir)), dim_products, "product_id")


@query("dim_users_merge")
def dim_users_merge(spark, sf_dir):
    return _dimension_after_run_2(written(bronze(spark, sf_dir)), dim_users, "user_id")


@query("affected_dates")
def affected_dates_(spark, sf_dir):
    fact, _, mart = _two_runs(spark, sf_dir)
    return affected_dates(fact, mart)


@query("affected_dates_semi")
def affected_dates_semi(spark, sf_dir):
    """On a fact in partitions by date, of which Spark reads those of the dates."""
    fact, _, mart = _two_runs(spark, sf_dir)
    folder = fresh_folder(spark)
    fact.withColumn("event_date", report_date()).write.partitionBy("event_date").parquet(folder)
    dated = spark.read.parquet(folder)
    dates = written(affected_dates(dated, mart)).where("report_date IS NOT NULL")
    return on_dates(dated, dates).drop("event_date")


@query("upsert_violations")
def upsert_violations(spark, sf_dir):
    """Keys that a merge refuses, of a dimension that came without deduplication."""
    return duplicate_or_null_keys(typed_events(bronze(spark, sf_dir, dirty=True)).select("product_id"), ["product_id"])


@query("marketing_report_incremental")
def marketing_report_incremental(spark, sf_dir):
    fact, products, mart = _two_runs(spark, sf_dir)
    return upsert(mart, marketing_report(fact, products, RUN_2, affected_dates(fact, mart)), GRAIN)


@query("marketing_report_replace_dates")
def marketing_report_replace_dates(spark, sf_dir):
    fact, products, mart = _two_runs(spark, sf_dir)
    dates = written(affected_dates(fact, mart))
    untouched = mart.join(dates, "report_date", "left_anti").select(*mart.columns)
    return untouched.unionByName(marketing_report(fact, products, RUN_2, dates))


# -- gold


def _report(spark, sf_dir) -> DataFrame:
    rows = bronze(spark, sf_dir)
    return marketing_report(fact_events(rows, RUN_2), dim_products(rows), RUN_2)


@query("marketing_report")
def marketing_report_full(spark, sf_dir):
    return _report(spark, sf_dir)


@query("revenue_by_day_brand")
def revenue_by_day_brand(spark, sf_dir):
    revenue = F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue")
    return _report(spark, sf_dir).groupBy("report_date", "brand").agg(revenue)


@query("conversion_rate")
def conversion_rate(spark, sf_dir):
    """Conversion over the whole period by brand."""
    fact = fact_with_products(fact_events(bronze(spark, sf_dir), RUN_2), dim_products(bronze(spark, sf_dir)))
    totals = fact.groupBy(known_or_unknown(F.col("brand")).alias("brand")).agg(
        F.count_if(is_type("view")).alias("total_views"), F.count_if(is_type("purchase")).alias("total_purchases")
    )
    rate = percent(F.col("total_purchases"), F.col("total_views"), 2)
    return totals.withColumn("conversion_rate_pct", rate)


@query("latest_report_top20")
def latest_report_top20(spark, sf_dir):
    return latest_report(_report(spark, sf_dir), 20)


@query("fact_dim_join")
def fact_dim_join(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return fact_with_products(fact_events(rows, RUN_2), dim_products(rows))


@query("fact_dim_preview")
def fact_dim_preview(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return preview_fact_with_products(fact_events(rows, RUN_2), dim_products(rows), 50)


@query("raw_marketing_mart")
def raw_mart(spark, sf_dir):
    return raw_marketing_mart(bronze(spark, sf_dir, dirty=True), RUN_2, on_bad_price="null")


# -- data quality


def _fact(spark, sf_dir, dirty=False) -> DataFrame:
    return fact_events(bronze(spark, sf_dir, dirty), RUN_2)


def _metric_query(name: str, metric: str) -> None:
    def run(spark, sf_dir):
        # Run 2 leaves a second row without id, so that uniqueness is below 100.
        fact = _fact_after_run_2(written(bronze(spark, sf_dir, dirty=True)))
        return quality.dq_metrics(fact, MEASURED, (metric,))

    query(name)(run)


_metric_query("dq_row_count", quality.ROW_COUNT)
_metric_query("dq_completeness", quality.COMPLETENESS)
_metric_query("dq_uniqueness", quality.UNIQUENESS)
_metric_query("dq_freshness", quality.FRESHNESS)
_metric_query("dq_invalid_purchase_price", quality.INVALID_PRICES)


@query("dq_pipeline_metrics")
def dq_pipeline_metrics(spark, sf_dir):
    fact = _fact_after_run_2(written(bronze(spark, sf_dir, dirty=True)))
    return metrics_by_name(quality.dq_metrics(fact, MEASURED))


@query("check_completeness")
def check_completeness(spark, sf_dir):
    """On a fact that lost a tenth of its product ids."""
    lost = F.when(F.col("product_id") % 10 != 0, F.col("product_id"))
    return quality.check_completeness(_fact(spark, sf_dir).withColumn("product_id", lost))


@query("dup_event_ids")
def dup_event_ids(spark, sf_dir):
    """On a fact that holds every tenth product's events twice."""
    fact = _fact_after_run_2(written(bronze(spark, sf_dir)))
    return quality.duplicate_event_ids(fact.unionByName(fact.filter("product_id % 10 = 0")))


@query("bad_purchase_prices")
def bad_purchase_prices(spark, sf_dir):
    return quality.bad_purchase_prices(_fact(spark, sf_dir, dirty=True))


@query("dup_mart_grain")
def dup_mart_grain(spark, sf_dir):
    """On a mart that holds the unknown brand's rows twice."""
    mart = written(_report(spark, sf_dir))
    return quality.duplicate_mart_grain(mart.unionByName(mart.filter("brand = '__UNKNOWN__'")))


@query("contract_violations")
def contract_violations_(spark, sf_dir):
    """A fact whose files drifted: prices are narrow, one column went, one came."""
    folder = fresh_folder(spark)
    drifted = _fact(spark, sf_dir).withColumn("price", F.col("price").cast("float")).drop("user_session")
    dated = drifted.withColumns({"campaign": F.lit("x"), "event_date": report_date()})
    dated.write.partitionBy("event_date").parquet(folder)
    return contract_violations(spark, "fact_events", [folder], "event_date")


# -- the production path: CSV files, the warehouse's builds, the raw mart job and a file stream


def _landing(lines: DataFrame, batch: int) -> str:
    """CSV files of one batch, named in the order of their events' times.

    Of rows without id, a build keeps one by ingest time, file name and event, so how many files there are must not
    change which file holds the latest event.
    """
    return csv_folder(lines.filter(F.col("batch") == batch).repartitionByRange("event_time"))


def _built(spark, sf_dir, **options) -> Warehouse:
    """A warehouse after two ingests of CSV files and two builds."""
    lines = written(event_lines(spark, sf_dir))
    warehouse = Warehouse(spark, fresh_folder(spark), on_violation="record", **options)
    for batch, as_of in ((1, RUN_1), (2, RUN_2)):
        warehouse.ingest_csv(_landing(lines, batch), INGESTED[batch])
        warehouse.build(as_of)
    return warehouse


@query("warehouse_mart")
def warehouse_mart(spark, sf_dir):
    return _built(spark, sf_dir).mart.read()


@query("warehouse_replace_dates")
def warehouse_replace_dates(spark, sf_dir):
    return _built(spark, sf_dir, mart_mode="replace_dates").mart.read()


@query("warehouse_full_refresh")
def warehouse_full_refresh(spark, sf_dir):
    """The first build saw batch 1 only; the refresh at the time of the second starts anew."""
    lines = written(event_lines(spark, sf_dir))
    warehouse = Warehouse(spark, fresh_folder(spark), on_violation="record")
    warehouse.ingest_csv(_landing(lines, 1), INGESTED[1])
    warehouse.build(RUN_1)
    warehouse.ingest_csv(_landing(lines, 2), INGESTED[2])
    warehouse.build(RUN_2, full_refresh=True)
    return warehouse.mart.read()


@query("warehouse_refresh_same_time")
def warehouse_refresh_same_time(spark, sf_dir):
    """A full refresh at the time of the last build takes all loads again, not that build's alone."""
    warehouse = _built(spark, sf_dir)
    warehouse.build(RUN_2, full_refresh=True)
    return warehouse.mart.read()


@query("warehouse_fact")
def warehouse_fact(spark, sf_dir):
    return _built(spark, sf_dir).fact.read().drop("source_file", "event_date")


@query("warehouse_metrics")
def warehouse_metrics(spark, sf_dir):
    return _built(spark, sf_dir).metrics.read()


@query("late_load_build")
def late_load_build(spark, sf_dir):
    """Batch 2 is committed after the first build but stamped before it."""
    rows = written(bronze(spark, sf_dir))
    warehouse = Warehouse(spark, fresh_folder(spark), on_violation="record")
    first = F.col("_file_name") == "batch_1.csv"
    warehouse.append_bronze(rows.filter(first), "first")
    warehouse.build(RUN_1)
    warehouse.append_bronze(rows.filter(~first).withColumn("_ingested_at", F.lit(INGESTED[1])), "late")
    warehouse.build(RUN_2)
    return warehouse.fact.read().drop("event_date")


@query("raw_mart_job")
def raw_mart_job(spark, sf_dir):
    output = fresh_folder(spark)
    build_raw_mart(spark, csv_folder(event_lines(spark, sf_dir, dirty=True)), output, RUN_2, on_bad_price="null")
    return spark.read.parquet(output)


@query("stream_to_bronze")
def stream_to_bronze(spark, sf_dir):
    landing = csv_folder(event_lines(spark, sf_dir))
    warehouse = Warehouse(spark, fresh_folder(spark))
    csv_to_bronze(warehouse, landing, fresh_folder(spark)).awaitTermination()
    return warehouse.bronze.read().select(*EVENT_COLUMNS)


@query("stream_rejects")
def stream_rejects(spark, sf_dir):
    """Ragged rows that come over a stream; its limit makes one batch of each file."""
    warehouse = Warehouse(spark, fresh_folder(spark))
    landing = _ragged_files(spark, sf_dir)
    csv_to_bronze(warehouse, landing, fresh_folder(spark), maxFilesPerTrigger="1").awaitTermination()
    value = F.replace("value", F.lit("\u0000"), F.lit(""))
    return warehouse.quarantine.read().select(value.alias("value"))


@query("ingest_ledger")
def ingest_ledger(spark, sf_dir):
    """Totals of the ledger by ingest, after each batch was offered twice."""
    lines = written(event_lines(spark, sf_dir))
    warehouse = Warehouse(spark, fresh_folder(spark))
    for batch in (1, 2):
        brand = F.when(every(59), F.concat("brand", F.lit(",more"))).otherwise(F.col("brand"))
        landing = csv_folder(lines.where(F.col("batch") == batch).withColumn("brand", brand), quote=False)
        for _ in range(2):
            warehouse.ingest_csv(landing, INGESTED[batch], on_bad_row="quarantine")
    files = warehouse.ledger.read().groupBy(F.col("_ingested_at").alias("ingested_at"))
    return files.agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))


@query("stream_ingest_summary")
def stream_ingest_summary(spark, sf_dir):
    """What the ledger says of message batches, which is counted while they are written."""
    warehouse, topic = Warehouse(spark, fresh_folder(spark)), fresh_folder(spark)
    _messages(spark, sf_dir).select(F.col("value").cast("string").alias("value")).write.text(topic)
    stream = spark.readStream.option("maxFilesPerTrigger", "1").text(topic)
    messages_to_bronze(warehouse, stream, fresh_folder(spark)).awaitTermination()
    entries = warehouse.ledger.read().agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))
    written_rows = warehouse.bronze.read().agg(F.count(F.lit(1)).alias("rows_in_bronze"))
    aside = warehouse.quarantine.read().agg(F.count(F.lit(1)).alias("rows_in_quarantine"))
    return entries.withColumns({"rows_in_bronze": written_rows.scalar(), "rows_in_quarantine": aside.scalar()})

"""The physical plans the operators must get, also when nothing may be broadcast."""

from __future__ import annotations

from datetime import datetime

import pytest

from pyspark.sql import functions as F

from tests.conftest import event
from tidemark import Warehouse
from tidemark.operators.dimensions import dim_products
from tidemark.operators.facts import fact_events
from tidemark.operators.incremental import duplicate_or_null_keys, upsert
from tidemark.operators.ingest import to_bronze, with_lineage
from tidemark.operators.marts import marketing_report
from tidemark.operators.quality import dq_metrics
from tidemark.plans.warehouse import by_date
from workload.bronze_view import written
from workload.queries import QUERIES

DAY = datetime(2020, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(bronze_frame):
    bronze = written(bronze_frame(event(), event(product_id="2")))
    return bronze, written(fact_events(bronze, DAY)), written(dim_products(bronze))


# Those that run whole builds before they return are compared in test_oracle; their last plan is a plain scan.
BUILDS = {name for name in QUERIES if name.startswith("warehouse_")} | {
    "late_load_build",
    "stream_to_bronze",
    "stream_rejects",
    "ingest_ledger",
    "stream_ingest_summary",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - BUILDS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert operator not in text


def test_deduplication_limits_before_the_shuffle(silver):
    text = plan(fact_events(silver[0], DAY))
    assert text.count("Exchange hashpartitioning") == 1
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_dimension_shrinks_by_hash_aggregation_before_the_shuffle(silver):
    text = plan(dim_products(silver[0]))
    assert "SortAggregate" not in text
    assert "HashAggregate" in text[text.rindex("Exchange hashpartitioning") :]
    assert "ReadSchema: struct<event_time:string,product_id:string,category_code:string,brand:string,_ingested_at:timestamp>" in text


def test_report_aggregates_before_it_joins(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(marketing_report(silver[1], silver[2], DAY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact_side = text[text.index("SortMergeJoin") : text.index("Filter isnotnull(product_id")]
    assert fact_side.index("HashAggregate") < fact_side.index("FileScan")
    assert "partial_sum" in fact_side
    assert "ReadSchema: struct<event_timestamp:timestamp_ntz,event_type:string,product_id:int,price:double>" in text


def test_distinct_ids_are_shuffled_alone(silver):
    text = plan(dq_metrics(silver[1], DAY))
    assert "ReadSchema: struct<event_id:string>" in text
    metric = plan(dq_metrics(silver[1], DAY, ("silver_fact_events_row_count",)))
    assert "event_id" not in metric


def test_incremental_scans_are_pruned(spark, tmp_path, bronze_frame):
    w = Warehouse(spark, str(tmp_path), on_violation="record")
    w.append_bronze(bronze_frame(event(), at=DAY), "1")
    w.build(datetime(2020, 1, 1, 1))
    w.append_bronze(bronze_frame(event(user_session="2"), at=datetime(2020, 1, 2)), "2")
    delta = w.bronze_of(["2"])
    assert "load" in plan(delta).split("PartitionFilters:")[1].split("]")[0]
    dates = w.touched.read().where(F.col("build") > "").select("event_date").distinct()
    text = plan(w._on_dates(dates).select("event_id"))
    assert "event_date" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<event_id:string>" in text


def test_upsert_evaluates_each_side_once(spark, silver):
    text = plan(upsert(silver[2], dim_products(silver[0]), ["product_id"]))
    assert text.count("FileScan") == 2
    assert duplicate_or_null_keys(silver[2], ["product_id"]).count() == 0


def test_load_of_bronze_is_written_without_shuffle(spark, bronze_frame):
    rows = to_bronze(with_lineage(bronze_frame(event()), "a.csv", DAY)).withColumn("load", F.lit("1"))
    assert "Exchange" not in plan(rows)
    assert "Exchange" in plan(by_date(fact_events(rows, DAY).withColumn("event_date", F.to_date("event_timestamp"))))

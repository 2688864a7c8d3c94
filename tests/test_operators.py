"""Edge semantics of silver, gold and data quality on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import event, rows
from tidemark.operators import quality
from tidemark.operators.dimensions import dim_products, dim_users
from tidemark.operators.facts import fact_events, null_id_rows
from tidemark.operators.incremental import anti_append, incremental_delta, upsert
from tidemark.operators.ingest import skip_ingested_files, union_batches
from tidemark.operators.marts import affected_dates, marketing_report, raw_marketing_mart
from tidemark.schemas import CONTRACT, FACT_EVENTS, contract_violations

DAY_1, DAY_2 = datetime(2020, 1, 1), datetime(2020, 1, 2)


def test_newest_ingest_wins_within_a_batch(bronze_frame):
    old = bronze_frame(event(price="1"), at=DAY_1)
    new = bronze_frame(event(price="2"), at=DAY_2)
    assert rows(fact_events(old.union(new), DAY_2).select("price", "source_file")) == [(2.0, "a.csv")]


def test_file_name_decides_equal_ingest_times(bronze_frame):
    both = bronze_frame(event(price="1"), file="b.csv").union(bronze_frame(event(price="2"), file="a.csv"))
    assert rows(fact_events(both, DAY_2).select("price", "source_file")) == [(1.0, "b.csv")]


def test_first_load_wins_across_batches(bronze_frame):
    first = fact_events(bronze_frame(event(price="1")), DAY_1)
    assert fact_events(bronze_frame(event(price="2"), at=DAY_2), DAY_2, existing=first).isEmpty()


def test_rows_without_id_leave_one_per_run(bronze_frame):
    lost = [event(user_session=None, price=str(p)) for p in (1, 2, 3)]
    first = fact_events(bronze_frame(*lost), DAY_1)
    second = fact_events(bronze_frame(*lost, at=DAY_2), DAY_2, existing=first)
    assert (first.count(), second.count()) == (1, 1)
    both = first.union(second)
    assert rows(quality.duplicate_event_ids(both)) == [(None, 2)]
    metrics = dict(rows(quality.dq_metrics(both, DAY_2).select("metric_name", "metric_value")))
    assert metrics[quality.UNIQUENESS] == "0.0"


def test_rows_without_id_can_be_set_aside(bronze_frame):
    bronze = bronze_frame(event(), event(user_session=None), event(user_session=None, price="9"))
    assert fact_events(bronze, DAY_1, null_id="quarantine").count() == 1
    assert null_id_rows(bronze).count() == 2
    with pytest.raises(ValueError, match="null_id"):
        fact_events(bronze, DAY_1, null_id="drop")


def test_anti_append_never_finds_null(spark):
    candidates = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, v int")
    existing = spark.createDataFrame([("a",), (None,), ("z",)], "id string")
    fresh = anti_append(candidates, existing, "id")
    assert sorted(rows(fresh), key=str) == [("b", 2), (None, 3)]


def test_watermark_is_strict_and_starts_at_epoch(spark, bronze_frame):
    bronze = bronze_frame(event(), at=DAY_1).union(bronze_frame(event(), at=DAY_2))
    empty = spark.createDataFrame([], FACT_EVENTS)
    assert incremental_delta(bronze, "_ingested_at", empty, "_loaded_at").count() == 2
    fact = fact_events(bronze.limit(1), DAY_1)
    assert rows(incremental_delta(bronze, "_ingested_at", fact, "_loaded_at").select("_ingested_at")) == [(DAY_2,)]


def test_dimension_takes_newest_ingest_then_newest_event(bronze_frame):
    old = bronze_frame(event(brand="late event, old ingest", event_time="2019-12-31 00:00:00 UTC"), at=DAY_1)
    new = bronze_frame(
        event(brand="early", event_time="2019-10-01 00:00:00 UTC"),
        event(brand="later", event_time="2019-10-02 00:00:00 UTC"),
        event(brand="no time", event_time="?"),
        at=DAY_2,
    )
    assert rows(dim_products(old.union(new)).select("brand", "_updated_at")) == [("later", DAY_2)]


def test_dimension_ties_have_one_answer(bronze_frame):
    tied = [event(brand=b) for b in ("b", "a", "c", None)]
    for order in (tied, tied[::-1]):
        assert rows(dim_products(bronze_frame(*order)).select("brand")) == [("c",)]


def test_dimension_key_is_the_integer(bronze_frame):
    bronze = bronze_frame(*[event(product_id=p, user_id=p) for p in ("1", "01", "abc", None, "2")])
    assert sorted(rows(dim_products(bronze).select("product_id"))) == [(1,), (2,)]
    assert sorted(rows(dim_users(bronze))) == [(1, "Ann", "Lee", DAY_1), (2, "Ann", "Lee", DAY_1)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(rows(upsert(target, source, ["k"]))) == [(1, "a"), (2, "B"), (3, "C")]


def _mart(bronze, as_of=DAY_1):
    return marketing_report(fact_events(bronze, as_of), dim_products(bronze), as_of)


def test_report_measures(bronze_frame):
    bronze = bronze_frame(
        event(user_session="1"),
        event(user_session="2"),
        event(user_session="3"),
        event(user_session="4", event_type="purchase", price="2.5"),
        event(user_session="5", event_type="purchase", price=None),
        event(user_session="6", event_type="cart"),
        event(user_session="7", event_type="View"),
    )
    assert rows(_mart(bronze)) == [(date(2019, 10, 1), "acme", "a", 3, 2, 2.5, 66.67, DAY_1)]


def test_report_of_other_types_only(bronze_frame):
    assert rows(_mart(bronze_frame(event(event_type="cart"))).drop("_refreshed_at")) == [
        (date(2019, 10, 1), "acme", "a", 0, 0, 0.0, None)
    ]


def test_report_leaves_out_unreadable_times_and_keeps_unknown_products(bronze_frame):
    bronze = bronze_frame(event(event_time="?"), event(product_id="x"), event(product_id="2", brand=" ", category_code=None))
    report = _mart(bronze).select("report_date", "brand", "category_l1", "total_views")
    assert rows(report) == [(date(2019, 10, 1), "__UNKNOWN__", "__UNKNOWN__", 2)]


def test_raw_mart_counts_copies_and_keeps_unreadable_times(bronze_frame):
    bronze = bronze_frame(
        event(brand="\tacme "),
        event(brand="acme"),
        event(event_time="2019-10-01", event_type="purchase", category_code=None),
    )
    raw = raw_marketing_mart(bronze, DAY_1).drop("_refreshed_at")
    assert sorted(rows(raw), key=str) == [
        (None, "acme", "__UNKNOWN__", 0, 1, 5.0, None),
        (date(2019, 10, 1), "acme", "a", 2, 0, 0.0, 0.0),
    ]


def test_raw_mart_and_bad_prices(bronze_frame):
    bronze = bronze_frame(event(event_type="purchase", price="n/a"), event(event_type="purchase", price="3"))
    assert rows(raw_marketing_mart(bronze, DAY_1, "null").select("revenue")) == [(3.0,)]
    with pytest.raises(Exception, match="Unreadable price: n/a"):
        raw_marketing_mart(bronze, DAY_1).collect()
    with pytest.raises(ValueError, match=r"\['brand', 'price'\]"):
        raw_marketing_mart(bronze.drop("price", "brand"), DAY_1)


def test_affected_dates(bronze_frame):
    old, new = event(), event(event_time="2019-10-02 00:00:00 UTC")
    bronze_1 = bronze_frame(old)
    first = fact_events(bronze_1, DAY_1)
    mart = marketing_report(first, dim_products(bronze_1), DAY_1)
    fact = first.union(fact_events(bronze_frame(old, new, event(event_time="?"), at=DAY_2), DAY_2, first))
    assert sorted(rows(affected_dates(fact, mart)), key=str) == [(None,), (date(2019, 10, 2),)]


def test_metrics_of_an_empty_fact(spark):
    empty = spark.createDataFrame([], FACT_EVENTS)
    metrics = dict(rows(quality.dq_metrics(empty, DAY_1).select("metric_name", "metric_value")))
    assert metrics == {
        quality.ROW_COUNT: "0",
        quality.COMPLETENESS: None,
        quality.UNIQUENESS: None,
        quality.INVALID_PRICES: None,
    }
    assert quality.failed_fact_checks(quality.fact_summary(empty).first()) == {}


def test_freshness_counts_second_boundaries(bronze_frame):
    fact = fact_events(bronze_frame(event()), datetime(2020, 1, 1, 0, 0, 0, 900_000))
    now = datetime(2020, 1, 1, 0, 0, 36, 100_000)
    metric = quality.dq_metrics(fact, now, (quality.FRESHNESS,)).select("metric_value", "unit")
    assert rows(metric) == [("0.01", "hours")]


def test_checks_agree_with_the_summary(bronze_frame):
    bad = [event(event_type="purchase", price=p, user_session=f"s{p}") for p in ("0", "-1", None, "x")]
    fact = fact_events(bronze_frame(*bad, event(user_id="x"), event(event_type=None, user_session="n")), DAY_1)
    failed = quality.failed_fact_checks(quality.fact_summary(fact).first())
    assert quality.bad_purchase_prices(fact).count() == failed["purchase_price_positive"] == 4
    assert rows(quality.check_completeness(fact)) == [(100.0 * 4 / 6,)]
    assert failed["completeness"] == 2
    doubled = fact.union(fact)
    surplus = quality.duplicate_event_ids(doubled).agg(F.sum(F.col("cnt") - 1)).first()[0]
    assert quality.failed_fact_checks(quality.fact_summary(doubled).first())["event_id_unique"] == surplus


def test_skip_and_union(bronze_frame):
    bronze = bronze_frame(event(), file="a.csv")
    incoming = bronze.union(bronze_frame(event(), file="b.csv"))
    assert rows(skip_ingested_files(incoming, bronze).select("_file_name")) == [("b.csv",)]
    assert skip_ingested_files(incoming, bronze.limit(0)).count() == 2
    narrow = bronze.select("brand", "price")
    assert rows(union_batches(narrow, narrow.select("price")).select("price", "brand")) == [("5.0", "acme"), ("5.0", None)]


def test_outputs_keep_the_contract(bronze_frame):
    bronze = bronze_frame(event())
    fact, products = fact_events(bronze, DAY_1), dim_products(bronze)
    tables = {
        "bronze_raw_events": bronze,
        "fact_events": fact,
        "dim_products": products,
        "dim_users": dim_users(bronze),
        "marketing_report": marketing_report(fact, products, DAY_1),
        "dq_pipeline_metrics": quality.dq_metrics(fact, DAY_1),
    }
    assert set(tables) == set(CONTRACT)
    for name, df in tables.items():
        assert contract_violations(df, name) == []
        assert df.columns == CONTRACT[name].names
    raw = raw_marketing_mart(bronze, DAY_1)
    assert contract_violations(raw, "marketing_report") == []
    wrong = products.withColumn("product_id", F.col("product_id").cast("bigint")).drop("brand").withColumn("x", F.lit(1))
    assert contract_violations(wrong, "dim_products") == [
        "dim_products.brand: missing",
        "dim_products.x: not in contract",
        "dim_products.product_id: bigint instead of int",
    ]

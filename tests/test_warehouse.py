"""Builds: two runs on the test tables, repetition, interruption, order of loads, full refresh."""

from __future__ import annotations

import shutil
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import event, rows
from tests.test_sources import write_csv
from tidemark import QualityError, Warehouse
from tidemark.clock import as_of_column, label
from tidemark.operators.contract import contract_violations
from tidemark.operators.incremental import upsert, watermark
from tidemark.operators.ingest import skip_ingested_files
from tidemark.operators.quality import fact_summary, summary_of_totals
from tidemark.schemas import EVENT_COLUMNS
from tidemark.sources.csv_files import list_csv
from workload.bronze_view import INGESTED, RUN_1, RUN_2, bronze

DAY = datetime(2020, 1, 1)


def warehouse(spark, path, **options) -> Warehouse:
    return Warehouse(spark, str(path), on_violation=options.pop("on_violation", "record"), **options)


def content(df, *without: str) -> list[tuple]:
    return sorted(rows(df.drop(*without)), key=str)


def load(w: Warehouse, frame, name: str) -> None:
    w.append_bronze(frame, name)


@pytest.fixture(scope="module")
def test_tables(spark):
    return bronze(spark, "/root/testdata/sf0.01").cache()


@pytest.mark.parametrize(("mode", "mart_rows"), [("merge", 2703), ("replace_dates", 2440)])
def test_two_runs_on_the_test_tables(spark, tmp_path, test_tables, mode, mart_rows):
    w = warehouse(spark, tmp_path, mart_mode=mode)
    by_batch = {n: test_tables.filter(F.col("_ingested_at") == as_of_column(INGESTED[n])) for n in (1, 2)}
    load(w, by_batch[1], "one")
    assert w.build(RUN_1).fact_rows == 7921
    assert w.mart.read().count() == 2085
    load(w, by_batch[2], "two")
    result = w.build(RUN_2)
    assert result.fact_rows == 1981
    assert result.violations["event_id_unique"] == 1
    assert w.fact.read().count() == 9902
    assert w.products.read().count() == 100
    assert w.users.read().count() == 150
    assert w.mart.read().count() == mart_rows
    metrics = {r.metric_name: r.metric_value for r in w.metrics.read().collect()}
    assert metrics["silver_fact_events_event_id_uniqueness_pct"] == "99.9798"
    # Built again without news: nothing changes but the measurement.
    before = content(w.mart.read()), content(w.fact.read()), content(w.products.read())
    assert w.build(RUN_2 + timedelta(hours=1)).fact_rows == 0
    assert (content(w.mart.read()), content(w.fact.read()), content(w.products.read())) == before
    # A full refresh collapses rows without id to one and drops stale groups.
    w.build(RUN_2 + timedelta(hours=2), full_refresh=True)
    assert (w.fact.read().count(), w.mart.read().count()) == (9901, 2440)


def test_loads_in_any_order_equal_a_full_refresh(spark, tmp_path, bronze_frame):
    october, november = "2019-10-05 00:00:00 UTC", "2019-11-05 00:00:00 UTC"
    batches = [
        [event(event_time=october), event(event_time=october, event_type="purchase", user_session="p")],
        [event(event_time=november), event(event_time="2018-01-01 00:00:00 UTC")],
        [event(event_time=october, user_session="late"), event(event_time=october), event(event_time="?")],
    ]
    w = warehouse(spark, tmp_path)
    for i, batch in enumerate(batches):
        load(w, bronze_frame(*batch, file=f"{i}.csv", at=DAY + timedelta(days=i)), str(i))
        w.build(DAY + timedelta(days=i, hours=1))
    assert w.fact.read().count() == 6
    step_by_step = content(w.mart.read(), "_refreshed_at"), content(w.fact.read().select("event_id"))
    w.build(DAY + timedelta(days=9), full_refresh=True)
    assert (content(w.mart.read(), "_refreshed_at"), content(w.fact.read().select("event_id"))) == step_by_step


def test_duplicate_with_unreadable_time_is_found_in_history(spark, tmp_path, bronze_frame):
    """Such rows have ids; they lie in the partition without a date."""
    w = warehouse(spark, tmp_path)
    for i in range(2):
        load(w, bronze_frame(event(event_time="?"), event(user_session=str(i)), at=DAY + timedelta(days=i)), str(i))
        w.build(DAY + timedelta(days=i, hours=1))
    assert w.fact.read().count() == 3


@pytest.mark.parametrize(("mode", "groups"), [("merge", ["new", "old"]), ("replace_dates", ["new"])])
def test_brand_change(spark, tmp_path, bronze_frame, mode, groups):
    """A merge keeps the group of the former brand, which then counts twice."""
    w = warehouse(spark, tmp_path, mart_mode=mode)
    other_day = "2019-10-09 00:00:00 UTC"
    load(w, bronze_frame(event(brand="old"), event(brand="old", event_time=other_day)), "1")
    w.build(DAY + timedelta(hours=1))
    load(w, bronze_frame(event(brand="new", user_session="x"), at=DAY + timedelta(days=1)), "2")
    w.build(DAY + timedelta(days=1, hours=1))
    mart = w.mart.read()
    assert sorted(r.brand for r in mart.filter(F.col("report_date") == date(2019, 10, 1)).collect()) == groups
    # The other date was not touched and keeps the former brand.
    assert rows(mart.filter(F.col("report_date") == date(2019, 10, 9)).select("brand")) == [("old",)]


def test_failed_check_stops_before_gold(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path, on_violation="raise")
    load(w, bronze_frame(event(event_type="purchase", price="0")), "1")
    with pytest.raises(QualityError) as failure:
        w.build(DAY + timedelta(hours=1))
    assert failure.value.violations == {"purchase_price_positive": 1}
    assert w.fact.read().count() == 1
    assert w.mart.read().isEmpty() and w.metrics.read().isEmpty()


def test_rows_without_id_in_quarantine(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path, null_id="quarantine", on_violation="raise")
    for i in range(2):
        batch = bronze_frame(event(user_session=None), event(user_session=str(i)), at=DAY + timedelta(days=i))
        load(w, batch, str(i))
        w.build(DAY + timedelta(days=i, hours=1))
    assert (w.fact.read().count(), w.null_ids.read().count()) == (2, 2)


def test_interrupted_build_goes_on(spark, tmp_path, bronze_frame, monkeypatch):
    w = warehouse(spark, tmp_path)
    load(w, bronze_frame(event()), "1")
    w.build(DAY + timedelta(hours=1))
    load(w, bronze_frame(event(user_session="x"), event(product_id="2"), at=DAY + timedelta(days=1)), "2")
    as_of = DAY + timedelta(days=1, hours=1)
    for step in ("_build_dimension", "_build_mart"):
        with monkeypatch.context() as patch:
            patch.setattr(w, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                w.build(as_of)
    assert w.build(as_of).fact_rows == 2
    assert w.fact.read().count() == 3
    assert rows(w.mart.read().agg(F.sum("total_views"))) == [(3,)]


def test_half_written_load_does_not_count(spark, tmp_path, bronze_frame, monkeypatch):
    w = warehouse(spark, tmp_path)
    load(w, bronze_frame(event()), "1")
    with monkeypatch.context() as patch:
        patch.setattr(w.ledger, "write", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load(w, bronze_frame(event(user_session="half"), event(user_session="more")), "2")
    assert w.bronze.read().count() == 1
    assert w.build(DAY + timedelta(hours=1)).fact_rows == 1
    load(w, bronze_frame(event(user_session="whole")), "2")
    load(w, bronze_frame(event(user_session="again")), "2")
    assert sorted(rows(w.bronze.read().select("user_session"))) == [("s",), ("whole",)]


def test_time_has_to_advance(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    load(w, bronze_frame(event()), "1")
    w.build(DAY + timedelta(hours=2))
    with pytest.raises(ValueError, match="not after the last build"):
        w.build(DAY + timedelta(hours=1))


def test_load_committed_late_is_not_lost(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    load(w, bronze_frame(event()), "1")
    w.build(DAY + timedelta(hours=2))
    # Stamped before that build, committed after it.
    load(w, bronze_frame(event(user_session="late", product_id="9", user_id="8"), at=DAY + timedelta(hours=1)), "2")
    assert w.build(DAY + timedelta(hours=3)).fact_rows == 1
    assert (w.fact.read().count(), w.products.read().count(), w.users.read().count()) == (2, 2, 2)


def test_loads_of_a_build_given_up_are_taken_by_the_next(spark, tmp_path, bronze_frame, monkeypatch):
    w = warehouse(spark, tmp_path)
    load(w, bronze_frame(event()), "1")
    for step in ("_build_fact", "_build_dimension"):
        with monkeypatch.context() as patch:
            patch.setattr(w, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                w.build(DAY + timedelta(hours=1 if step == "_build_fact" else 2))
    w.build(DAY + timedelta(hours=3))
    assert (w.fact.read().count(), w.products.read().count(), w.users.read().count()) == (1, 1, 1)


def test_totals_by_date_equal_the_summary_of_the_fact(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    times = ["2019-10-01 00:00:00", "2019-10-02 00:00:00", "?"]
    for i in range(3):
        batch = [event(event_time=t, user_session=str(i)) for t in times[i:]]
        load(w, bronze_frame(*batch, event(user_session=None), event(event_type="purchase", price="0")), str(i))
        w.build(DAY + timedelta(hours=i))
    columns = sorted(fact_summary(w.fact.read()).columns)
    assert rows(summary_of_totals(w.totals.read()).select(columns)) == rows(fact_summary(w.fact.read()).select(columns))
    assert sorted(str(r[0]) for r in w.totals.read().select("event_date").collect()) == ["2019-10-01", "2019-10-02", "None"]
    # The last build touched two of the three dates.
    last = w.touched.read().where(F.col("build") == label(DAY + timedelta(hours=2))).select("event_date")
    assert sorted(str(r[0]) for r in last.collect()) == ["2019-10-01", "None"]


def test_load_stamped_ahead_counts_once(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    load(w, bronze_frame(event(), event(user_session=None), at=DAY + timedelta(days=9)), "1")
    assert w.build(DAY + timedelta(hours=2)).fact_rows == 2
    result = w.build(DAY + timedelta(hours=3))
    assert (result.fact_rows, result.violations) == (0, {})
    assert w.fact.read().count() == 2


def test_two_ingests_at_one_time(spark, tmp_path):
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    w = warehouse(spark, tmp_path / "warehouse")
    write_csv(landing / "one.csv", event())
    assert w.ingest_csv(str(landing), DAY, str(archive)) == {"one.csv": 1}
    write_csv(landing / "two.csv", event(user_session="2"), event(user_session="3"))
    assert w.ingest_csv(str(landing), DAY, str(archive)) == {"two.csv": 2}
    assert w.bronze.read().count() == 3
    assert sorted(p.name for p in archive.glob("*.csv")) == ["one.csv", "two.csv"]


def test_bad_rows_and_other_layouts(spark, tmp_path):
    landing = tmp_path / "landing"
    write_csv(landing / "one.csv", event())
    with open(landing / "one.csv", "a") as file:
        file.write("too,short\n")
    whole = (landing / "one.csv").read_text().splitlines()
    columns = whole[0].split(",")
    turned = [",".join(reversed(columns)), ",".join(reversed(whole[1].split(",")))]
    (landing / "turned.csv").write_text("\n".join(turned) + "\n")
    (landing / "wrong.csv").write_text("a,b\n1,2\n")
    w = warehouse(spark, tmp_path / "warehouse")
    with pytest.raises(ValueError, match="Missing required columns"):
        w.ingest_csv(str(landing), DAY, on_bad_row="quarantine")
    loaded = w.bronze.read()
    assert loaded.count() == 2
    assert loaded.select(*EVENT_COLUMNS).distinct().count() == 1
    assert rows(w.quarantine.read().select("value", "_file_name")) == [("too,short", "one.csv")]
    assert w.known_files(str(landing)) == ["one.csv", "turned.csv"]


def test_csv_to_report(spark, tmp_path):
    """The whole path: landing files, skipped names, archive, silver, gold, metrics."""
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    write_csv(landing / "one.csv", event(), event(), event(event_type="purchase", user_session="p"))
    write_csv(landing / "two.csv", event(user_session="2", brand=""))
    w = warehouse(spark, tmp_path / "warehouse", on_violation="raise")
    assert w.ingest_csv(str(landing), DAY, str(archive)) == {"one.csv": 3, "two.csv": 1}
    assert sorted(p.name for p in archive.glob("*.csv")) == ["one.csv", "two.csv"]
    result = w.build(DAY + timedelta(hours=1))
    assert (result.fact_rows, result.violations) == (3, {})
    # A known name stays in the landing directory unread, whatever it holds; a new name is loaded.
    write_csv(landing / "one.csv", event(user_session="ignored"))
    write_csv(landing / "three.csv", event(), event(user_session="3"))
    assert w.ingest_csv(str(landing), DAY + timedelta(hours=2), str(archive)) == {"three.csv": 2}
    assert [p.name for p in landing.glob("*.csv")] == ["one.csv"]
    assert w.build(DAY + timedelta(hours=3)).fact_rows == 1
    assert w.ingest_csv(str(landing), DAY + timedelta(hours=4)) == {}
    mart = w.mart.read().select("report_date", "total_views", "total_purchases", "revenue")
    assert mart.agg(F.sum("total_views"), F.sum("total_purchases"), F.sum("revenue")).first()[:] == (3, 1, 5.0)
    metrics = {r.metric_name: r.metric_value for r in w.metrics.read().collect()}
    assert metrics["silver_fact_events_row_count"] == "4"
    assert metrics["silver_fact_events_freshness_hours"] == "0.0"


def test_many_dates_and_rows_without_date(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    times = ["2019-10-01 00:00:00", "2019-10-02 00:00:00", "2019-10-03 00:00:00", "?"]
    for i in range(2):
        batch = bronze_frame(*[event(event_time=t) for t in times], event(user_session=str(i)), at=DAY + timedelta(days=i))
        load(w, batch, str(i))
        w.build(DAY + timedelta(days=i, hours=1))
    assert w.fact.read().count() == 6
    assert rows(w.mart.read().agg(F.sum("total_views"))) == [(5,)]


def test_files_follow_dates_not_builds(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    for i in range(6):
        load(w, bronze_frame(event(user_session=str(i)), event(event_time="?", user_session=str(i))), str(i))
        assert w.build(DAY + timedelta(hours=i)).fact_rows == 2
    for table in (w.fact, w.mart, w.totals):
        assert len(list(Path(table.path).rglob("*.parquet"))) <= 2
    assert w.fact.read().count() == 12
    assert rows(w.mart.read().select("total_views")) == [(6,)]
    assert rows(watermark(w.fact.read(), "_loaded_at")) == [(DAY + timedelta(hours=5),)]


def test_full_refresh_after_one_that_was_given_up(spark, tmp_path, bronze_frame, monkeypatch):
    """Whatever came before, a full refresh equals a fresh warehouse of the same loads."""
    batches = [
        [event(user_session=str(i)) for i in range(5)] + [event(user_session=None, product_id="3")],
        [event(user_session=str(i), brand="new", event_time="2019-10-02 00:00:00 UTC") for i in range(3)] + [event(user_session=None)],
    ]
    old, new = warehouse(spark, tmp_path / "old"), warehouse(spark, tmp_path / "new")
    for i, batch in enumerate(batches):
        for w in (old, new):
            load(w, bronze_frame(*batch, file=f"{i}.csv", at=DAY + timedelta(days=i)), str(i))
        old.build(DAY + timedelta(days=i))
    # At the time of the last build, and interrupted.
    with monkeypatch.context() as patch:
        patch.setattr(old, "_build_dimension", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            old.build(DAY + timedelta(days=1), full_refresh=True)
    # A build that is not asked to start anew does so then.
    at = DAY + timedelta(days=1, hours=1)
    assert old.build(at).fact_rows == new.build(at).fact_rows == 9
    for name in ("fact", "mart", "products", "users", "metrics", "totals"):
        assert content(getattr(old, name).read()) == content(getattr(new, name).read()), name
    # And the next build goes on from there.
    load(old, bronze_frame(event(user_session="0"), event(user_session="next"), at=DAY + timedelta(days=2)), "next")
    assert old.build(DAY + timedelta(days=2)).fact_rows == 1


@pytest.mark.parametrize("table", ["fact", "products", "mart"])
def test_replacement_cut_off_half_way(spark, tmp_path, bronze_frame, monkeypatch, table):
    """The new rows are staged when the job dies in the middle of putting them in place, some of the old ones gone."""
    w = warehouse(spark, tmp_path)
    dates = ["2019-10-01 00:00:00 UTC", "2019-10-02 00:00:00 UTC"]
    load(w, bronze_frame(*[event(event_time=d) for d in dates]), "1")
    w.build(DAY)
    second = [event(event_time=d, user_session="2", brand="new") for d in dates] + [event(user_session=None)]
    load(w, bronze_frame(*second, at=DAY + timedelta(days=1)), "2")
    with monkeypatch.context() as patch:

        def die():
            folder = Path(getattr(w, table).path)
            shutil.rmtree((sorted(folder.glob("*=*")) or [folder])[0])
            raise RuntimeError("lost")

        patch.setattr(getattr(w, table), "settle", lambda calls=iter([lambda: None, die]): next(calls)())
        with pytest.raises(RuntimeError, match="lost"):
            w.build(DAY + timedelta(days=1))
    w.build(DAY + timedelta(days=1, hours=1))
    assert w.fact.read().count() == 5
    assert content(w.products.read().select("product_id", "brand")) == [(1, "new")]
    mart = content(w.mart.read().select("report_date", "brand", "total_views"))
    october = [date(2019, 10, 1), date(2019, 10, 2)]
    assert mart == [(october[0], "acme", 1), (october[0], "new", 3), (october[1], "acme", 1), (october[1], "new", 2)]


def test_dates_are_pruned_when_the_build_runs(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    for i in range(3):
        load(w, bronze_frame(event(event_time=f"2019-10-0{i + 1} 00:00:00 UTC"), at=DAY + timedelta(days=i)), str(i))
        w.build(DAY + timedelta(days=i))
    dates = w.touched.read().where(F.col("build") > label(DAY + timedelta(days=1))).select("event_date").distinct()
    facts = w._on_dates(dates)
    plan = facts._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
    assert facts.count() == 1
    assert len({r[0] for r in facts.select(F.col("event_date")).collect()}) == 1


def test_builds_read_the_loads_they_need(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path)
    for i in range(3):
        load(w, bronze_frame(event(user_session=str(i))), str(i))
    plan = w.bronze_of(["1"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(load" in plan
    assert rows(w.bronze_of(["1"]).select("user_session")) == [("1",)]


def test_ledger_remembers_files_without_good_rows(spark, tmp_path):
    landing = tmp_path / "landing"
    write_csv(landing / "good.csv", event(), event())
    write_csv(landing / "header_only.csv")
    write_csv(landing / "bad_only.csv")
    with open(landing / "bad_only.csv", "a") as file:
        file.write("a,b\nc\n")
    w = warehouse(spark, tmp_path / "warehouse")
    counts = {"good.csv": 2, "header_only.csv": 0, "bad_only.csv": 0}
    assert w.ingest_csv(str(landing), DAY, on_bad_row="quarantine") == counts
    for i in range(2):
        assert w.ingest_csv(str(landing), DAY + timedelta(hours=i), on_bad_row="quarantine") == {}
    assert sorted(rows(w.ledger.read().select("_file_name", "rows_loaded", "rows_rejected"))) == [
        ("bad_only.csv", 0, 2),
        ("good.csv", 2, 0),
        ("header_only.csv", 0, 0),
    ]
    assert w.quarantine.read().count() == 2
    # What decides is the ledger: bronze is not part of the plan.
    listed = skip_ingested_files(list_csv(spark, str(landing)), w.ledger.read())
    assert "bronze_raw_events" not in listed._jdf.queryExecution().toString()


def test_drifted_files_stop_a_build_before_gold(spark, tmp_path, bronze_frame):
    w = warehouse(spark, tmp_path, on_violation="raise")
    load(w, bronze_frame(event(), event(event_time="2019-10-02 00:00:00 UTC")), "1")
    assert w.build(DAY).violations == {}
    assert w.contract_violations().isEmpty()
    # Another job appends files of its own making to one date.
    alien = spark.createDataFrame([("x", "17", 1)], "event_id string, product_id string, campaign int")
    alien.write.mode("append").parquet(w.fact.partition_path(date(2019, 10, 1)))
    found = {(r.column_name, r.found) for r in w.contract_violations().collect()}
    assert found == {(None, "several types")}
    load(w, bronze_frame(event(event_time="2019-10-02 00:00:00 UTC", user_session="2"), at=DAY + timedelta(days=1)), "2")
    # The other date is sound.
    assert w.build(DAY + timedelta(days=1)).violations == {}
    other = Path(w.users.path)
    renamed = spark.createDataFrame([(1, "n")], "user_id int, name string")
    renamed.write.mode("overwrite").parquet(str(other))
    faults = {(r.column_name, r.declared, r.found, r.row_count) for r in contract_violations(spark, "dim_users", [str(other)]).collect()}
    assert ("name", None, "string", 1) in faults and ("user_surname", "string", None, 1) in faults
    assert len(faults) == 4


def test_upsert_refuses_unsound_sources(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    for source in ([(2, "b"), (2, "c")], [(None, "b")]):
        with pytest.raises(Exception, match="share a key or lack one"):
            upsert(target, spark.createDataFrame(source, "k int, v string"), ["k"]).collect()
    assert content(upsert(target, spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"])) == [(1, "b"), (2, "c")]

"""CSV files, JSON messages and the raw mart job."""

from __future__ import annotations

import csv
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import EVENT_DEFAULTS, event, rows
from tidemark.plans.raw_mart import build_raw_mart
from tidemark.schemas import EVENT_COLUMNS
from tidemark.sources.csv_files import list_csv, read_events
from tidemark.sources.json_messages import decode_events, encode_events, kafka_messages, malformed_messages, publish_events


def write_csv(path, *events: dict, columns=EVENT_COLUMNS):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, columns, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(events)
    return str(path)


def test_fields_are_text_and_empty_is_null(spark, tmp_path):
    path = tmp_path / "a.csv"
    write_csv(path, event(brand='say "hi", ok', price="007", user_name="", user_surname=" ", category_code="é"))
    path.write_text(path.read_text().replace("Lee", "Lee") + "t,,,,,,,,,\"\",\n")
    first, second = sorted(read_events(spark, str(path)).collect(), key=lambda r: r.event_time)
    assert (first.brand, first.price, first.user_name, first.user_surname, first.category_code) == (
        'say "hi", ok',
        "007",
        None,
        " ",
        "é",
    )
    assert (second.event_time, second.user_name, second.user_surname) == ("t", None, None)


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", event(brand="two\nlines"))
    assert rows(read_events(spark, path, multi_line=True).select("brand")) == [("two\nlines",)]


@pytest.mark.parametrize("name", ["plain.csv", "a b.csv", "a+b.csv", "50%.csv", "é.csv"])
def test_file_names_come_back_unchanged(spark, tmp_path, name):
    write_csv(tmp_path / name, event())
    assert rows(list_csv(spark, str(tmp_path)).select("_file_name")) == [(name,)]
    paths = [r.path for r in list_csv(spark, str(tmp_path)).collect()]
    assert rows(read_events(spark, paths).select("_file_name")) == [(name,)]


def test_listing_takes_only_csv(spark, tmp_path):
    for name in ("a.csv", "b.CSV", "c.csv.gz", "d.txt"):
        (tmp_path / name).write_text("x")
    assert rows(list_csv(spark, str(tmp_path)).select("_file_name")) == [("a.csv",)]


def test_columns_are_found_by_name(spark, tmp_path):
    shuffled = ("price", "extra", *[c for c in EVENT_COLUMNS if c != "price"])
    path = write_csv(tmp_path / "a.csv", event(price="9", extra="x"), columns=shuffled)
    df = read_events(spark, path)
    assert set(df.columns) == {*EVENT_COLUMNS, "_file_name"}
    assert rows(df.select("price", "brand")) == [("9", "acme")]


def test_another_header_fails_instead_of_shifting_columns(spark, tmp_path):
    write_csv(tmp_path / "a.csv", event())
    write_csv(tmp_path / "b.csv", event(), columns=EVENT_COLUMNS[::-1])
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_events(spark, str(tmp_path)).collect()


def test_missing_input_and_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="No input CSV files"):
        read_events(spark, str(tmp_path / "*.csv"))
    path = write_csv(tmp_path / "a.csv", event(), columns=EVENT_COLUMNS[:-1])
    with pytest.raises(ValueError, match=r"Missing required columns: \['user_surname'\]"):
        read_events(spark, path)


def test_messages_round_trip(spark, events_frame):
    sent = events_frame(event(), event(brand=None, price="1.50", user_name='q"é'))
    messages = encode_events(sent)
    assert sorted(rows(decode_events(messages)), key=str) == sorted(rows(sent), key=str)
    for row in messages.collect():
        assert set(json.loads(row.value)) == set(EVENT_COLUMNS)


def test_malformed_messages_are_set_aside(spark):
    good = json.dumps(EVENT_DEFAULTS)
    values = [
        good.encode(),
        json.dumps(EVENT_DEFAULTS | {"campaign": "x"}).encode(),
        b'{"brand": "acme", "price": 2.5}',
        f"\n {good}\t".encode(),
        b"not json",
        b"[1,2]",
        f"[{good}]".encode(),
        b"null",
        b"",
        b'{"brand": "acme"',
        b'{"brand": "acme"} tail',
        b'{"brand": "\xff"}',
        None,
    ]
    messages = spark.createDataFrame([(bytearray(v) if v is not None else None,) for v in values], "value binary")
    kept = decode_events(messages)
    assert kept.count() == 4
    assert rows(kept.filter("event_time IS NULL").select("brand", "price")) == [("acme", "2.5")]
    rejected = [bytes(r.value) if r.value is not None else None for r in malformed_messages(messages).collect()]
    assert sorted(rejected, key=str) == sorted(values[4:], key=str)


def test_publish(spark, events_frame, tmp_path):
    publish_events(events_frame(event(), event()), format="text", path=str(tmp_path / "topic"))
    assert decode_events(spark.read.text(str(tmp_path / "topic"))).count() == 2


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "broker:9092", "shop-clicks", "group")


def test_raw_mart_job(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", event(), event(event_type="purchase"))
    write_csv(tmp_path / "in" / "b.csv", event(brand="other"))
    out, as_of = str(tmp_path / "mart"), datetime(2020, 1, 1)
    for _ in range(2):
        assert build_raw_mart(spark, str(tmp_path / "in" / "*.csv"), out, as_of) == 2
    mart = spark.read.parquet(out)
    assert sorted(rows(mart.select("brand", "total_views", "revenue"))) == [("acme", 1, 5.0), ("other", 1, 0.0)]
    assert {r[0] for r in rows(mart.select("_refreshed_at"))} == {as_of}

    write_csv(tmp_path / "bad" / "c.csv", event(price="n/a"))
    with pytest.raises(Exception, match="Unreadable price"):
        build_raw_mart(spark, str(tmp_path / "bad"), out, as_of)
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(ValueError, match="No input"):
        build_raw_mart(spark, str(tmp_path / "none" / "*.csv"), out, as_of)
    assert spark.read.parquet(out).agg(F.sum("total_purchases")).first()[0] == 1

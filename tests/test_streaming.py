"""Streams into bronze, replay, and agreement with the batch path."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pytest

from tests.conftest import event, rows
from tests.test_sources import write_csv
from tidemark import Warehouse
from tidemark.operators.facts import typed_events
from tidemark.sources.csv_files import read_events
from tidemark.streaming import ingest


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def loads(w) -> list[str]:
    return sorted(r[0] for r in w.ledger.read().select("load").distinct().collect())


def test_messages(spark, tmp_path):
    topic, checkpoint = tmp_path / "topic", str(tmp_path / "checkpoint")
    topic.mkdir()
    w = Warehouse(spark, str(tmp_path / "warehouse"), on_violation="record")
    good = [event(user_session=str(i)) for i in range(3)]
    (topic / "1.txt").write_text("\n".join([*map(json.dumps, good), "not json", "[1,2]"]))

    def drain():
        run(ingest.messages_to_bronze(w, spark.readStream.text(str(topic)), checkpoint))

    drain()
    assert w.bronze.read().count() == 3
    assert sorted(rows(w.quarantine.read().select("value"))) == [("[1,2]",), ("not json",)]
    # Nothing new: no batch.
    drain()
    assert len(loads(w)) == 1
    # Redelivery and news; the fact keeps one row per event.
    (topic / "2.txt").write_text("\n".join(map(json.dumps, [good[0], event(user_session="new")])))
    drain()
    assert w.bronze.read().count() == 5
    labels = loads(w)
    assert [label.rsplit("_", 1)[1] for label in labels] == ["00000000", "00000001"]
    assert {r[0] for r in rows(w.bronze.read().select("_file_name").distinct())} == set(labels)
    entries = rows(w.ledger.read().orderBy("load").select("_file_name", "rows_loaded", "rows_rejected"))
    assert entries == [(labels[0], 3, 2), (labels[1], 2, 0)]
    w.build(datetime.now(timezone.utc) + timedelta(seconds=1))
    assert w.fact.read().count() == 4
    # The same batch again, as after a crash between write and commit: already there.
    assert not w.append_bronze(w.bronze.read(), labels[0])
    assert w.bronze.read().count() == 5
    # Another checkpoint starts over and must not be taken for a replay.
    run(ingest.messages_to_bronze(w, spark.readStream.text(str(topic)), str(tmp_path / "other")))
    assert w.bronze.read().count() == 10


def test_landing_files(spark, tmp_path):
    landing, archive, checkpoint = tmp_path / "landing", tmp_path / "archive", str(tmp_path / "checkpoint")
    archive.mkdir()
    w = Warehouse(spark, str(tmp_path / "warehouse"), on_violation="record")
    write_csv(landing / "one.csv", event(), event(user_session="2", brand=""))
    (landing / "notes.txt").write_text("x")
    for _ in range(2):
        run(ingest.csv_to_bronze(w, str(landing), checkpoint, str(archive)))
    assert sorted(rows(w.bronze.read().select("_file_name", "brand")), key=str) == [
        ("one.csv", "acme"),
        ("one.csv", None),
    ]
    # A file the batch path has loaded is passed over by the stream.
    write_csv(tmp_path / "batch" / "two.csv", event(user_session="b"))
    w.ingest_csv(str(tmp_path / "batch"), datetime.now(timezone.utc))
    write_csv(landing / "two.csv", event(user_session="other content"))
    write_csv(landing / "three.csv", event(user_session="3"))
    run(ingest.csv_to_bronze(w, str(landing), checkpoint, str(archive)))
    assert sorted(rows(w.bronze.read().select("_file_name", "user_session")), key=str) == [
        ("one.csv", "2"),
        ("one.csv", "s"),
        ("three.csv", "3"),
        ("two.csv", "b"),
    ]
    # Spark archives files of finished batches under their full path.
    assert [p.name for p in archive.rglob("*.csv")] == ["one.csv"]


def test_ragged_rows_and_odd_files_do_not_stop_a_stream(spark, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    w = Warehouse(spark, str(tmp_path / "warehouse"))
    write_csv(landing / "good.csv", event(), event(user_session="2"))
    with open(landing / "good.csv", "a") as file:
        file.write(",".join(["x"] * 13) + "\nonly,three,fields\n")
    (landing / "odd.csv").write_text("a,b\n1,2\n3,4\n")
    header, line = (landing / "good.csv").read_text().splitlines()[:2]
    turned = [",".join(reversed(x.split(","))) for x in (header, line)]
    (landing / "turned.csv").write_text("\n".join(turned) + "\n")
    for i in range(2):
        run(ingest.csv_to_bronze(w, str(landing), checkpoint))
        write_csv(landing / f"later{i}.csv", event(user_session=f"later{i}"))
    run(ingest.csv_to_bronze(w, str(landing), checkpoint))
    # Also a stream that starts anew finds the files in the ledger.
    run(ingest.csv_to_bronze(w, str(landing), str(tmp_path / "anew")))
    assert sorted(rows(w.ledger.read().select("_file_name", "rows_loaded", "rows_rejected"))) == [
        ("good.csv", 2, 2),
        ("later0.csv", 1, 0),
        ("later1.csv", 1, 0),
        ("odd.csv", 0, 3),
        ("turned.csv", 1, 0),
    ]
    assert sorted(rows(w.quarantine.read().select("value"))) == sorted(
        (v,) for v in ["a,b", "1,2", "3,4", ",".join(["x"] * 13), "only,three,fields"]
    )
    loaded = w.bronze.read()
    assert sorted(rows(loaded.select("user_session"))) == [("2",), ("later0",), ("later1",), ("s",), ("s",)]
    assert loaded.where("_file_name = 'turned.csv'").first()["brand"] == "acme"


@pytest.mark.parametrize("kind", ["files", "messages"])
def test_drain_in_batches_goes_on_after_a_crash(spark, tmp_path, monkeypatch, kind):
    """Six batches; the job dies after the third was written and before Spark noted it."""
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    landing.mkdir()
    w = Warehouse(spark, str(tmp_path / "warehouse"))
    for i in range(6):
        if kind == "files":
            write_csv(landing / f"{i}.csv", event(user_session=str(i)), event(user_session=f"{i}b"))
        else:
            lines = [json.dumps(event(user_session=s)) for s in (str(i), f"{i}b")]
            (landing / f"{i}.txt").write_text("\n".join([*lines, "bad"]))

    def start():
        if kind == "files":
            return ingest.csv_to_bronze(w, str(landing), checkpoint, maxFilesPerTrigger="1")
        return ingest.messages_to_bronze(w, spark.readStream.option("maxFilesPerTrigger", 1).text(str(landing)), checkpoint)

    name = "load_files" if kind == "files" else "append_messages"
    with monkeypatch.context() as patch:
        calls, load = [], getattr(w, name)

        def dies(*args, **options):
            load(*args, **options)
            calls.append(1)
            if len(calls) == 3:
                raise RuntimeError("lost")

        patch.setattr(w, name, dies)
        query = start()
        with pytest.raises(Exception, match="lost"):
            query.awaitTermination(120)
    assert w.bronze.read().count() == 6
    run(start())
    assert sorted(r[0] for r in w.bronze.read().select("user_session").collect()) == sorted([*"012345", *[f"{i}b" for i in range(6)]])
    assert len(loads(w)) == 6
    assert w.quarantine.read().count() == (0 if kind == "files" else 6)


def test_both_paths_give_the_same_ids(spark, tmp_path):
    events = [event(), event(product_id="007", event_time="2019-10-01 01:02:03"), event(user_session=""), event(price="")]
    path = write_csv(tmp_path / "a.csv", *events)
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "1.txt").write_text("\n".join(map(json.dumps, events)))
    w = Warehouse(spark, str(tmp_path / "warehouse"))
    run(ingest.messages_to_bronze(w, spark.readStream.text(str(tmp_path / "topic")), str(tmp_path / "checkpoint")))
    from_csv = w_rows(spark, read_events(spark, path))
    assert w_rows(spark, w.bronze.read()) == from_csv
    assert len({r[0] for r in from_csv}) == 3


def w_rows(spark, bronze):
    from pyspark.sql import functions as F

    typed = typed_events(bronze.withColumn("_ingested_at", F.current_timestamp()))
    return sorted(rows(typed.drop("_ingested_at", "source_file")), key=str)

"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        path = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == list(seen)

    before, after = seen["language_id"]
    assert {r["doc_id"] for r in after} == {i for i, t in before.items() if t and any(c.isalpha() for c in t)}

    before, after = seen["quality_rules"]
    kept = {r["doc_id"] for r in after}
    assert kept and not any(brute.quality_counts(before[i])[-1] for i in kept)

    before, after = seen["near_duplicates"]
    expected = {i for i, v in brute.near_duplicates(list(before.items()), 80).items() if v[2]}
    assert {r["doc_id"] for r in after} == expected

    before, after = seen["repeats"]
    expected = brute.repeats(list(before.items()))
    for row in after:
        _, gone, _, digest = expected[row["doc_id"]]
        # A cut may fall inside a character, whose other bytes go as well.
        if gone == 0 or before[row["doc_id"]].isascii():
            assert hashlib.sha256(row["text"].encode()).hexdigest() == digest

    before, after = seen["packing"]
    assert {r["doc_id"] for r in after} == set(before)
    assert all(r["length"] == 1 << r["bucket"] for r in after)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "start", "length", "ids", "sequence_id"} <= set(rows.columns)
    assert rows.count() > 0

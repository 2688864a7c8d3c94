"""Decontamination, resampling and periodic runs against their brute-force versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from tests.compare import differences, duckdb_over
from tests.llm import brute

from tidemark.llm import decontamination, periodic, queries, resampling

DOCUMENTS = "doc_id long, text string, ref string, term int, score double, runs string, item string, key int"
ITEMS = "item_id long, text string, words string, query int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def prose(n: int, seed: int, pick_from: int = 60) -> str:
    pick = random.Random(seed)
    vocabulary = ["the", "of", "is", *[f"w{i}" for i in range(pick_from)], "Über", "ñandú", "字"]
    weights = [20, 15, 10, *[1] * (len(vocabulary) - 3)]
    return " ".join(pick.choices(vocabulary, weights, k=n))


@pytest.fixture(scope="module")
def items() -> list[tuple[int | None, str | None]]:
    shared = prose(14, 7)
    return [
        (1, prose(30, 1)),
        (2, prose(12, 2).upper()),
        (3, f"{shared} tail end"),
        (30, shared),
        (30, prose(11, 8)),
        (4, "short item here"),
        (5, "the"),
        (6, "absentword"),
        (7, None),
        (8, ""),
        (9, " .,;\n"),
        (None, prose(11, 9)),
        (10, "the of the of the of the of the of the of"),
        (11, prose(30, 1)),
    ]


@pytest.fixture(scope="module")
def texts(items) -> list[tuple[int, str | None]]:
    body = [t for _, t in items]
    out: list[str | None] = [prose(80, 100 + i) for i in range(12)]
    out += [f"{prose(9, 50)}, {body[0].replace(' ', '... ')} {prose(20, 51)}", body[0], body[0], body[0][:60]]
    out += [" ".join(body[0].split()[3:16]), " ".join(body[0].split()[:9]), f"x {body[1].lower()}-{body[1]}", body[3], f"{body[2]} {body[2]}"]
    out += [None, "", " \n\t", "!!! ###", "the", "The of", "a short ITEM here, short item here short item", body[11], body[4]]
    out += ["the of " * 40, "of " + "the of " * 4 + "the", prose(20_000, 99) + " " + body[1], "w1" * 5000 + " w2", body[12]]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1, 0.5, "y", "z", 3) for i, t in rows], DOCUMENTS).repartition(5)

    return make


@pytest.fixture(scope="module")
def item_frame(spark):
    return lambda rows: spark.createDataFrame([(i, t, "x", 1) for i, t in rows], ITEMS)


# ---------------------------------------------------------------- decontamination


def digest(found: set) -> str:
    return sha(",".join(sorted(str(i) for i in found)))


@pytest.mark.parametrize("length", [10, 3])
def test_contamination(frame, item_frame, texts, items, length):
    rows = decontamination.contamination(frame(texts), item_frame(items), length).collect()
    expected = {i: (n, h, len(f), digest(f), h > 0) for i, (n, h, f) in brute.contamination(texts, items, length).items()}
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected
    assert sum(e[4] for e in expected.values()) > 8 or length == 10


def test_contamination_joins_by_shuffle_alike(frame, item_frame, texts, items, monkeypatch):
    def sorted_rows():
        return sorted(decontamination.contamination(frame(texts), item_frame(items)).collect())

    broadcast = sorted_rows()
    monkeypatch.setattr(decontamination, "broadcast_if_small", lambda df: df)
    assert sorted_rows() == broadcast


def test_contamination_of_nothing(frame, item_frame, texts, items):
    assert decontamination.contamination(frame([]), item_frame(items)).collect() == []
    clean = decontamination.contamination(frame(texts), item_frame([])).collect()
    assert len(clean) == len(texts) and not any(r["contaminated"] or r["n_items"] for r in clean)
    assert {r["items_sha256"] for r in clean} == {sha("")}


def test_repeated_and_null_ids_are_documents_of_their_own(frame, item_frame, items):
    rows = [(1, items[0][1]), (1, "clean text"), (None, items[0][1]), (None, None)]
    got = decontamination.contamination(frame(rows), item_frame(items)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_items"]) for r in got) == [(0, 0, 0), (0, 30, 3), (1, 2, 0), (1, 30, 3)]


@pytest.mark.parametrize("span", [2, 7])
def test_proximity(frame, spark, texts, span):
    wanted = [(0, ["w1", "w2"]), (1, ["of", "is", "w5"]), (2, ["the"]), (3, ["the", "of", "the"]), (4, ["absentword", "the"])]
    index = decontamination.PositionalIndex.build(frame(texts))
    got = index.near(spark.createDataFrame(wanted, "query long, words array<string>"), span)
    got = got.join(index.documents, "ref").select("query", "key", "pos").collect()
    expected = set()
    rare = {r["word"]: (r["n"], r["term"]) for r in index.terms.collect()}
    for q, query in wanted:
        if any(w not in rare for w in query):
            continue
        first = min(query, key=lambda w: (rare[w][0], query.index(w)))
        for i, text in texts:
            words = brute.LETTERS.findall(brute.lower(text or ""))
            expected |= {(q, i, p) for p in brute.near(words, query, span) if words[p] == first}
    assert {tuple(r) for r in got} == expected
    assert len({q for q, _, _ in expected}) > 2


def test_main_paths_have_no_python(frame, item_frame, texts, items):
    plan = decontamination.contamination(frame(texts), item_frame(items))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# ---------------------------------------------------------------- resampling


def test_crc_of_spans():
    pick = random.Random(1)
    words = [bytes(pick.choices(range(256), k=pick.choice([0, 1, 2, 3, 7, 47, 48, 49, 200]))) for _ in range(300)]
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    data = np.frombuffer(b"".join(words), np.uint8)
    crc = resampling.crc_spans(data, starts, ends)
    assert crc.tolist() == [zlib.crc32(w) for w in words]
    more = resampling.crc_spans(data, starts, ends, crc[::-1].copy())
    assert more.tolist() == [zlib.crc32(w, int(c)) for w, c in zip(words, crc[::-1], strict=True)]


@pytest.mark.parametrize(("percent", "longest", "buckets"), [(10, 1, 10_000), (100, 1, 50), (37, 3, 1000)])
def test_resampling(frame, item_frame, texts, items, percent, longest, buckets):
    many = texts + [(1000 + i, prose(19 + i % 9, 500 + i // 3)) for i in range(150)]
    got = resampling.resample(frame(many), item_frame(items), percent, longest=longest, buckets=buckets).collect()
    expected = brute.resampling(many, [t for _, t in items], percent, 2024, longest, buckets)
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected
    assert all(d == "bigint" for _, d in frame(many).select("doc_id").dtypes)


def test_resampling_of_repeated_rows_and_nothing(frame, item_frame, items):
    rows = [(i, prose(25, i)) for i in (1, 2, 3, 4)] * 5 + [(None, prose(30, 9))] * 2
    got = resampling.resample(frame(rows), item_frame(items), 50).collect()
    assert len(got) == 22 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 12))
    assert resampling.resample(frame([]), item_frame(items)).collect() == []
    few = resampling.resample(frame([(1, None), (2, "a b")]), item_frame([])).collect()
    assert sorted((r["doc_id"], r["n_features"], r["rank"]) for r in few) == [(1, 0, None), (2, 2, None)]


def test_cutoff_at_every_rank(spark):
    pick = random.Random(3)
    rows = [(i, pick.choice([None, *range(9)]), pick.randint(-3, 3)) for i in range(60)]
    scores = spark.createDataFrame(rows, "ref long, doc_id long, score long").repartition(6).cache()
    order = sorted(rows, key=lambda r: (-r[2], r[1] is None, r[1] or 0, r[0]))
    for rank in (1, 17, 60):
        won = {r["ref"] for r in scores.where(resampling.cutoff(scores, rank)).collect()}
        assert won == {r[0] for r in order[:rank]}
    ranks = {r["ref"]: r["rank"] for r in resampling.ranked(scores).collect()}
    assert ranks == {r[0]: i + 1 for i, r in enumerate(order)}
    with pytest.raises(ValueError, match="rank"):
        resampling.cutoff(scores, 61)


def test_a_pivot_discards_a_quarter():
    pick = random.Random(5)
    for _ in range(200):
        parts = [sorted(pick.randint(0, 50) for _ in range(pick.randint(1, 40))) for _ in range(pick.randint(1, 12))]
        pivot = resampling._weighted_median([(len(p), (p[(len(p) - 1) // 2],)) for p in parts])[0]
        every = sorted(x for p in parts for x in p)
        assert 4 * sum(x <= pivot for x in every) >= len(every)
        assert 4 * sum(x >= pivot for x in every) >= len(every)


# ---------------------------------------------------------------- periodic runs


@pytest.fixture(scope="module")
def repetitive() -> list[tuple[int, str | None]]:
    pick = random.Random(11)
    out: list[str | None] = [None, "", " \n", "a", "a a a", "a a a a a a", "a b " * 3, "a b a b a b a b", "a a b a a b " * 4]
    for n in range(60):
        letters = pick.choices("abc" if n % 2 else "ab", k=pick.randint(1, 7))
        out.append(" ".join(pick.choices("abc", k=pick.randint(0, 12)) + letters * pick.randint(1, 9) + pick.choices("ab", k=5)))
    for _ in range(25):
        out.append(" ".join(pick.choices("ab", k=pick.randint(20, 160))))
    for period in (13, 31, 32, 33, 64, 100):
        unit = [f"v{i}" for i in range(period)]
        out.append(" ".join([*pick.choices("xy", k=17), *(unit * 6)[: 4 * period + pick.randint(0, 50)], "end"]))
        out.append(" ".join((unit * 5)[: 4 * period - 1]))
    out += ["z " * 700, ("p q r s " * 5 + "t ") * 8, "line one\nline one\r\n" * 30, prose(3000, 4), "é x " * 9, "  a" * 20]
    return list(enumerate(out))


def expected_collapse(rows) -> dict:
    out = {}
    for i, text in rows:
        words = brute.SPACED.findall(text or "")
        found, top, kept = brute.collapsed(words)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        out[i] = (len(words), len(found), *top, sha(lines), sha(kept), kept, found)
    return out


@pytest.mark.parametrize("long_words", [1 << 16, 40])
def test_collapse(frame, repetitive, long_words, monkeypatch):
    monkeypatch.setattr(periodic, "LONG_WORDS", long_words)
    got = periodic.collapse(frame(repetitive)).collect()
    names = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed")
    mine = {r["doc_id"]: (*[r[c] for c in names], [tuple(x) for x in r["runs"]]) for r in got}
    assert mine == expected_collapse(repetitive)


def test_collapse_of_nothing_and_repeated_ids(frame):
    assert periodic.collapse(frame([])).collect() == []
    got = periodic.collapse(frame([(1, "a " * 6), (1, "b c"), (None, "a " * 7), (None, None)]), with_text=False).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_runs"]) for r in got) == [(0, 0, 0), (0, 7, 1), (1, 2, 0), (1, 6, 1)]


def test_planted_runs(frame, repetitive):
    docs = [(i * 7 + k, t) for i, t in repetitive for k in range(3)]
    got = {r["doc_id"]: r["text"] for r in queries.with_planted_runs(frame(docs)).collect()}
    assert got == {i: brute.planted_runs(i, t) for i, t in docs}


# ---------------------------------------------------------------- whole tables


COLUMNS = {
    "op11_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op12_resampling": "doc_id n_features weight score rank",
    "op13_periodic": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_equal_their_twins(spark, name):
    folder = "/root/testdata/sf0.001"
    count, problems = differences(spark, duckdb_over(folder), queries.QUERIES[name], queries.ORACLE[name], folder)
    assert (count, problems) == (200, [])
    assert queries.QUERIES[name](spark, folder).columns == COLUMNS[name].split()

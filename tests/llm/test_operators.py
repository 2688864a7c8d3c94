"""Each operator against its brute-force version, with the awkward rows that its docstring defines."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tests.llm import brute
from tokenizers import Tokenizer

from tidemark.llm import (
    bpe,
    embeddings,
    language,
    licenses,
    near_duplicates,
    packing,
    quality,
    repeats,
    scoring,
    sharding,
)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORD_TOKENS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def sentences(n: int, seed: int, words: int = 60) -> list[str]:
    pick = random.Random(seed)
    parts = ["the", "of", "and", "tion", "er", "ing", "re", "con", "est", "al", "ou", "über", "ñ", "mit", "license", "Li"]
    return [" ".join("".join(pick.choices(parts, k=pick.randint(1, 3))) for _ in range(words)) for _ in range(n)]


@pytest.fixture(scope="module")
def texts() -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, shared passages, long and short ones, blanks and nulls."""
    base = sentences(40, 1)
    passage = sentences(1, 2, 30)[0]
    out: list[str | None] = [*base, base[0], base[0], base[1] + " tail", "start " + base[1], base[2].replace("the", "tho", 1)]
    out += [f"{b} {passage}\n{b[:70]}" for b in sentences(8, 3)]
    out += [None, "", " \n\t", "word", "Word", "a b c d", "A B C D", "x" * 300, "x" * 301, "y" + "x" * 120]
    out += [(base[3] + "\n") * 4, " ".join(sentences(60, 5)), "Released under the MIT License.", "apache   LICENSE, mit-license"]
    out += ["Licensed under CC BY-NC 4.0.\n" + base[5], "the gnu general public license", "mit\x00license mitlicense"]
    out += ["ab " * 200, "é" * 80, "zé" + "é" * 90, "!!! ### " * 40, "0 1 2 3 4 5 6 7 8 9 " * 12]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None) for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


def by_id(df, *columns: str, key: str = "doc_id") -> dict:
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


# ---------------------------------------------------------------- packing


@pytest.mark.parametrize("n", [0, 1, 2, 3, 2047, 2048, 2049, 10_000])
def test_pieces_are_powers_of_two_and_gapless(n):
    pieces = packing.power_of_two_pieces(n)
    assert sum(length for _, length in pieces) == n
    assert all(length & (length - 1) == 0 and length <= 2048 for _, length in pieces)
    assert [s for s, _ in pieces] == list(np.cumsum([0, *[length for _, length in pieces]])[:-1][: len(pieces)])


def test_packing(docs, texts):
    library = Tokenizer.from_file(WORD_TOKENS)
    rows = packing.pack(docs, WORD_TOKENS).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [x for r in mine for x in r["ids"]] == ids
        for r in mine:
            piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert (r["ids_crc32"], r["doc_tokens"], r["offset"]) == (zlib.crc32(piece.tobytes()), len(ids), 0)
            assert r["length"] == 2 ** r["bucket"]


@pytest.mark.parametrize("cached", [1_000_000, 10])
def test_word_tokens_at_odd_borders(cached):
    import pyarrow as pa

    from tidemark.llm.words import WordTokens

    library = Tokenizer.from_file(WORD_TOKENS)
    pick = random.Random(4)
    signs = ["a", "B", "'s", "'", ".", "…", "́", "̸", "<", "5", "Ⅷ", "字", " ", "\n", "\t", "\x1c", "　", "İ", "Σ", "Ñ", "ß"]
    signs += ["<|endoftext|>", "<|", "|>", "×", "÷", "ÿ", "é", "the", "ing", "-", "(", "\x00", "w" * 47, "🙂", "\r\n", "ǅ", "ſ"]
    made: list = ["".join(pick.choices(signs, k=pick.randint(0, 12))) for _ in range(6000)]
    made += [" ".join(pick.choices(["tion", "con", "ñas", "über", "x", "qu"], k=9)).replace(" ", "", 5) for _ in range(3000)]
    ids, borders = WordTokens(WORD_TOKENS, cached).encode(pa.array([*made, None]))
    theirs = [e.ids for e in library.encode_batch(made, add_special_tokens=False)]
    ours = [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:], strict=True)]
    assert ours.pop() == []
    assert [m for m, a, b in zip(made, ours, theirs, strict=True) if a != b] == []


def test_remembered_pieces_do_not_change_ids():
    import pyarrow as pa

    from tidemark.llm.words import WordTokens

    parts = [pa.array(sentences(30, i)) for i in range(6)]
    all_known, forgetful = WordTokens(WORD_TOKENS), WordTokens(WORD_TOKENS, 50)
    for part in parts * 2:
        (a, at), (b, bt) = all_known.encode(part), forgetful.encode(part)
        assert a.tolist() == b.tolist() and at.tolist() == bt.tolist()
    for empty in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        ids, borders = all_known.encode(empty)
        assert len(ids) == 0 and borders.tolist() == [0] * (len(empty) + 1)


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def reference_encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(docs, texts, reference_encoding):
    found = by_id(bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN), "n_tokens", "ids_sha256", "decoded", "ids")
    for i, text in texts:
        ids = reference_encoding.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i] == (len(ids), digest, (text or "").encode(), ids)


def test_bpe_of_random_texts(reference_encoding):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    pick = random.Random(6)
    signs = [" ", " ", "\n", "\t", "a", "th", "'s", "!", " ", "　", "ß", "\x1c", "\x85", "字", "😀", "٣", "Ⅷ"]
    made = ["".join(pick.choices(signs, k=pick.randint(0, 40))) for _ in range(3000)] + ["ab" * 4000, " " * 999 + "x"]
    theirs = [np.array(reference_encoding.encode_ordinary(t), "<u4").tobytes() for t in made]
    assert encoder.encode(made) == theirs
    assert [encoder.decode(x) for x in theirs] == [t.encode() for t in made]


# ---------------------------------------------------------------- sharding


def test_sharding(docs, texts):
    rows = sharding.assign(docs, [1.0] * 4).collect()
    assert sorted(r["doc_id"] for r in rows) == [i for i, _ in texts]
    for shard in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    sizes = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts}
    assert all((r["size"], r["text_crc32"]) == sizes[r["doc_id"]] for r in rows)
    assert all(r["grown_shard"] in (r["shard"], 4) for r in rows)


def test_shards_follow_their_weights_and_move_little(spark):
    from pyspark.sql import functions as F

    keys = spark.range(20_000).select(
        sharding.rendezvous_shard(F.col("id").cast("string"), [1, 1, 2]).alias("a"),
        sharding.rendezvous_shard(F.col("id").cast("string"), [1, 1, 2, 4]).alias("b"),
    )
    counts = {r["a"]: r["count"] for r in keys.groupBy("a").count().collect()}
    assert counts[2] == pytest.approx(10_000, rel=0.05)
    assert keys.where("a <> b AND b <> 3").count() == 0
    assert keys.where("b = 3").count() == pytest.approx(10_000, rel=0.05)


def test_sharding_of_null_and_repeated_keys(spark):
    rows = spark.createDataFrame([(None, "a"), (None, None), (1, "a"), (1, "a")], "doc_id long, text string")
    found = sharding.assign(rows, [1.0] * 3).collect()
    assert len({(r["shard"], r["slot"]) for r in found}) == 4


# ---------------------------------------------------------------- language


def test_language(spark):
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    model = language.TextModel.fit(docs.where("doc_id % 2 = 0"))
    blind = docs.where("doc_id % 2 = 1").selectExpr("doc_id", "text", "lang AS truth", "CAST(NULL AS string) AS lang", "source")
    held = language.of_documents(blind, model).collect()
    assert sum(r["language"] == r["truth"] for r in held) / len(held) > 0.98
    pages = language.of_pages(spark.read.parquet(f"{root}/pages.parquet"), model)
    assert pages.where("NOT known").count() == 0


def test_language_of_awkward_rows(spark, docs, nothing):
    model = language.TextModel.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    rows = language.of_documents(docs, model, prefix="_")
    assert rows.columns == [*docs.columns, "_language", "_confidence", "_known"]
    found = by_id(rows, "text", "_language", "_known")
    blanks = {k for k, v in found.items() if not (v[0] or "").strip()}
    assert blanks and all(found[k][1:] == (None, False) for k in blanks)
    assert language.of_documents(nothing, model).count() == 0
    assert language.keep_known(nothing).count() == 0


def test_rare_and_many_languages_are_learnt(spark):
    rows = [(i, "the quick brown fox jumps over", "en") for i in range(21_000)]
    rows += [(30_000, "ωμέγα θάλασσα ουρανός γη", "el")]
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows += [(40_000 + i, f"q{a}{b}{a}z{b}{b}{a}q " * 5, f"{a}{b}x") for i, (a, b) in enumerate(zip(alphabet * 3, "abc" * 26, strict=True))]
    docs = spark.createDataFrame([(i, t, x, "s", None) for i, t, x in rows], DOCUMENTS).repartition(4)
    model = language.TextModel.fit(docs)
    assert set(model.languages) == {x for _, _, x in rows} and len(model.languages) > 64
    assert all(model.table.max(0) > model.table.min(0))
    kept = {r["doc_id"] for r in language.keep_known(docs.where("doc_id >= 30000"), model).collect()}
    assert 30_000 in kept


# ---------------------------------------------------------------- embeddings


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 24)
    random = np.random.default_rng(2)
    centre = random.normal(size=(6, 8))
    rows = [(i, (centre[i % 6] + random.normal(size=8) * 0.25).tolist()) for i in range(150)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, [3 * x for x in rows[0][1]]), (203, None), (204, [0.0] * 8), (205, [])]
    rows += [(206, [1.0, float("nan")]), (207, [None, 1.0]), (208, [1.0, 0.0]), (209, [2.0, 0.01]), (210, [float("inf")] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = by_id(embeddings.deduplicate(frame), "n_links", "component_id", "kept", key="vec_id")
    assert found == brute.cosine_links(rows, 0.95)
    assert embeddings.deduplicate(frame.limit(0)).count() == 0


def test_embeddings_of_extreme_size(spark):
    """Huge and tiny vectors link by their direction and leave the links of others alone."""
    rows = [(0, [1.0, 1.0]), (1, [2.0, 2.0]), (2, [1e200, 1e200]), (3, [1e308, 1e308]), (4, [1e-200, 0.0]), (5, [5e-324, 0.0])]
    rows += [(6, [1.0, 0.0]), (7, [-1e300, 1e-300]), (8, [1e308, 1.0]), (9, [0.0, -0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = by_id(embeddings.deduplicate(frame), "n_links", "component_id", key="vec_id")
    alike = {i: 0 for i in range(4)} | {i: 4 for i in (4, 5, 6, 8)} | {7: 7, 9: 9}
    assert found == {i: (3 if i in (0, 1, 2, 3, 4, 5, 6, 8) else 0, alike[i]) for i in range(10)}


def test_embeddings_in_many_strips(spark, monkeypatch):
    """Strips, blocks and lengths decide only which pairs need no look; many vectors of one direction are dealt by hash."""
    monkeypatch.setattr(embeddings, "BLOCK", 4)
    monkeypatch.setattr(embeddings, "STRIP", 2)
    random = np.random.default_rng(8)
    centre = random.normal(size=(5, 8))
    near = [centre[i % 5] + random.normal(size=8) * (0.2 if i % 3 else 0.6) for i in range(160)]
    near += [random.normal(size=3) for _ in range(60)] + [centre[0] * 2.0**i * 3 for i in range(30)]
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(near)] + [(1000 + i, np.float32(near[i]).tolist()) for i in range(0, 220, 7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = by_id(embeddings.deduplicate(frame), "n_links", "component_id", "kept", key="vec_id")
    assert found == brute.cosine_links(rows, 0.95)


def test_embeddings_are_shuffled_a_few_times_only(spark, monkeypatch):
    """However many pairs of blocks there are (none can be excluded here), what is shuffled follows the vectors."""
    monkeypatch.setattr(embeddings, "BLOCK", 32)
    vectors = np.random.default_rng(9).normal(size=(1000, 64)).astype(np.float32)
    frame = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<float>")

    def shuffled() -> dict[str, int]:
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        files = [files.apply(i) for i in range(files.size())]
        return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}

    before, during, save = shuffled(), {}, embeddings.saved

    def saved(frame):
        """Looks before Spark can clean up."""
        out = save(frame)
        during.update(shuffled())
        return out

    monkeypatch.setattr(embeddings, "saved", saved)
    assert embeddings.deduplicate(frame).where("n_links > 0").count() == 0
    during.update(shuffled())
    assert sum(size for name, size in during.items() if name not in before) < 4 * vectors.nbytes


def test_links_by_products_are_those_by_trees(monkeypatch):
    """Products in single precision leave what is close to the threshold to doubles."""
    random = np.random.default_rng(10)
    x = random.normal(size=(1, 6)) + random.normal(size=(120, 6)) * 0.3
    unit = embeddings.units(x)
    x = embeddings.scaled(x)
    one, other = (embeddings.Block(x[part], embeddings.cover_levels(unit[part])) for part in (slice(0, 70), slice(70, 120)))
    cosines = embeddings._cosines(one, other, np.arange(70).repeat(50), np.tile(np.arange(50), 70))
    monkeypatch.setattr(embeddings, "TILE", (16, 32))
    for least in sorted(cosines)[::500]:
        wanted = np.stack(np.nonzero((cosines >= least).reshape(70, 50)), 1).tolist()
        monkeypatch.setattr(embeddings, "NODE_COST", 0)
        by_trees = sorted(embeddings.dual_links(one, other, least).tolist())
        monkeypatch.setattr(embeddings, "NODE_COST", 1 << 30)
        assert by_trees == sorted(embeddings.dual_links(one, other, least).tolist()) == wanted


def test_cover_tree_covers():
    points = np.random.default_rng(3).normal(size=(200, 5))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    levels = embeddings.cover_levels(points)
    assert sorted(levels[-1][0].tolist()) == list(range(200))
    for (upper, _, radius), (lower, parent, _) in zip(levels, levels[1:], strict=False):
        assert set(upper) <= set(lower)
        gaps = np.linalg.norm(points[lower] - points[upper[parent]], axis=1)
        assert (gaps <= radius[parent] + 1e-9).all()


def test_rules_are_ordered_by_what_they_reject_of_the_rest(spark, monkeypatch):
    """The second rule rejects much, but only what the first rejects already; rows that fail the base don't count."""
    texts = [f"{'many ' * (i % 10 > 3)}{'some ' * (i % 10 > 4)}{'few ' * (i % 10 < 2)}" + " ".join(f"w{i}x{j}" for j in range(25)) for i in range(60)]
    frame = spark.createDataFrame([*enumerate(texts), *[(100 + i, "few") for i in range(300)]], "doc_id long, text string")
    rules = tuple(quality.Rule(w, f"array_contains(words, '{w}')") for w in ("some", "many", "few"))
    monkeypatch.setattr(quality, "time", SimpleNamespace(perf_counter=lambda: 0.0))
    assert [r.name for r in quality.ordered(frame, rules)] == ["many", "few", "some"]
    assert quality.ordered(frame.limit(0), rules) == list(rules)


# ---------------------------------------------------------------- language: clashes and regions


def test_language_beside_columns_of_its_own_names(spark):
    rows = [(i, t, "en-US" if i % 2 else "EN_gb", "s", "x", "y", "z", 1) for i, t in enumerate(sentences(40, 8))]
    names = "doc_id long, text string, lang string, source string, language string, known string, _is_known string, _ll int"
    frame = spark.createDataFrame(rows, names)
    model = language.TextModel.fit(frame)
    assert model.languages == ["en"]
    judged = language.of_documents(frame, model)
    assert set(judged.columns) == set(frame.columns) | {"confidence"}
    assert {(r["language"], r["known"]) for r in judged.collect()} == {("en", True)}
    kept = language.keep_known(frame)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect())) == sorted(rows)


def test_declarations_with_regions_count(spark):
    """Declared regions agree with labels, so what is declared decides where the text does not."""
    rows = [(i, "der die und ist nicht", "de-AT", "s") for i in range(30)] + [(30 + i, "the and is not of", "en-US", "s") for i in range(30)]
    rows += [(100, "the and", "de-CH", "s"), (101, "qxqx", "de_DE", "s"), (102, "qxqx", "en", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = by_id(language.of_documents(frame, language.TextModel.fit(frame)), "language")
    assert (found[101], found[102]) == (("de",), ("en",))


# ---------------------------------------------------------------- quality


def test_quality(docs, texts):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = quality.judge(docs)
    found = by_id(judged, *names)
    assert found == {i: brute.quality_counts(t) for i, t in texts}
    kept = {r["doc_id"] for r in judged.collect() if r["kept"]}
    assert kept and not any(found[i][-1] for i in kept)
    rows = quality.keep_good(docs)
    assert rows.columns == docs.columns
    assert {r["doc_id"] for r in rows.collect()} == kept


def test_order_of_rules_does_not_change_the_verdict(docs, monkeypatch):
    expected = by_id(quality.judge(docs), "kept")
    monkeypatch.setattr(quality, "ordered", lambda counted, rules: list(rules)[::-1])
    assert by_id(quality.judge(docs), "kept") == expected


# ---------------------------------------------------------------- licenses


def test_licenses(docs, texts):
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts)
    by = {r["doc_id"]: r for r in rows}
    for i, text in texts:
        r = by[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute.license_base(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
        assert ("cc-by-nc" in r["labels"]) == ("CC BY-NC" in (text or ""))


def test_notice_with_changed_words_is_found_where_it_stands(spark):
    notice = licenses.TEMPLATES[5][2].split()
    notice[10:12] = ["some", "other", "words"]
    text = " ".join(["lorem"] * 30 + notice + ["ipsum"] * 30)
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["labels"] == "mit" and row["base_labels"] == "" and row["score"] > 0.9
    assert (row["spans"][0]["first_word"], row["spans"][0]["end_word"]) == (30, 30 + len(notice))


def test_licenses_of_like_wording_are_told_apart(spark):
    cases = {
        "licensed under CC BY 4.0": "cc-by",
        "Licensed under CC BY-SA 4.0": "cc-by-sa",
        "licensed under CC BY-NC 4.0": "cc-by-nc",
        "License: CC BY-NC 4.0": "cc-by-nc",
        "licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
        "released under the mit": "",
        "licensed under the mozilla license version 2.0": "",
        "this work is licensed under the gnu free documentation license version 3": "",
        "licensed under CC BY-NC 3.0": "cc-by-nc",
    }
    texts = [f"lorem ipsum. {t}. dolor sit" for t in cases]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = by_id(rows, "labels")
    assert [found[i][0] for i in range(len(texts))] == list(cases.values())


# ---------------------------------------------------------------- near duplicates


def test_near_duplicates(docs, texts, monkeypatch):
    found = by_id(near_duplicates.deduplicate(docs, 80), "n_shingles", "component_id", "kept")
    assert found == brute.near_duplicates(texts, 80)


def test_large_group_in_blocks(spark, monkeypatch):
    """A chain of texts in which the first is like only a few, so that most links are found in blocks."""
    monkeypatch.setattr(near_duplicates, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near_duplicates, "BLOCK", 7)
    words = sentences(1, 9, 400)[0].split()
    rows = [(i, " ".join(words[4 * i : 4 * i + 200])) for i in range(40)]
    found = by_id(near_duplicates.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), 85), "n_shingles", "component_id", "kept")
    assert found == brute.near_duplicates(rows, 85)


def test_one_row_of_each_group_stays(spark, docs, nothing):
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {i for i, v in by_id(near_duplicates.deduplicate(docs), "kept").items() if v[0]}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    assert near_duplicates.keep_one(nothing).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b"), (2, "A B")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in near_duplicates.keep_one(rows).collect()) == ["1", "None", "None"]


# ---------------------------------------------------------------- repeats


def test_repeats(docs, texts):
    found = by_id(repeats.measure(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == brute.repeats(texts)


def test_repeats_over_many_ranges_and_groups(docs, texts, monkeypatch):
    monkeypatch.setattr(repeats, "spread", lambda *a, **k: 200)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 2_000)
    found = by_id(repeats.measure(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == brute.repeats(texts)


def test_repeats_with_null_and_repeated_ids(spark, nothing):
    long = "abcdefghij" * 9
    rows = spark.createDataFrame([(None, long), (1, long), (1, long), (2, "x" + long)], "doc_id long, text string")
    found = sorted((str(r["doc_id"]), r["n_removed"]) for r in repeats.measure(rows).collect())
    assert found == [("1", 0), ("1", 0), ("2", 90), ("None", 0)]
    assert repeats.measure(nothing).count() == 0
    assert repeats.remove_repeats(rows).columns == rows.columns


def test_slices_do_not_depend_on_the_order_of_arrival(docs, monkeypatch):
    orders, runs = [], repeats._runs

    def seen(met, borders, groups):
        def keys(batches):
            for batch in batches:
                yield batch.select(["id", "d1", "d2"])

        for source in (met, met):
            rows = source.mapInArrow(keys, "id long, d1 long, d2 long")
            orders.append(rows.rdd.glom().map(lambda p: [tuple(r) for r in p]).collect())
        return runs(met, borders, groups)

    monkeypatch.setattr(repeats, "_runs", seen)
    repeats.measure(docs.unionAll(docs.selectExpr("doc_id + 1000", "text", "lang", "source", "n_chars")).repartition(7)).count()
    assert any(len(p) > 1 for p in orders[0])
    assert all(p == sorted(p) for order in orders for p in order)


def test_merge_of_runs_never_compares_known_prefixes():
    pick = random.Random(8)
    pool = np.frombuffer(bytes(pick.choice(b"ab") for _ in range(repeats.ITEM * 300)), np.uint8).reshape(300, -1)
    runs, everything = [], []
    for _ in range(7):
        rows = pool[sorted(pick.sample(range(300), 60))]
        rows = rows[np.argsort(repeats._strings(rows))]
        shared, rest = repeats.front_code(rows)
        ends = np.cumsum(repeats.ITEM - shared.astype(int)).tolist()
        raw = rest.tobytes()
        runs.append((shared.tolist(), [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]))
        everything += [r.tobytes() for r in rows]
    merged = list(repeats.merge_runs(runs))
    assert [m[3] for m in merged] == sorted(everything)
    for a, b in zip(merged, merged[1:], strict=False):
        common = next((i for i, (x, y) in enumerate(zip(a[3], b[3], strict=True)) if x != y), repeats.ITEM)
        assert b[2] == common


# ---------------------------------------------------------------- scoring


def test_base_scores(docs, texts):
    found = by_id(scoring.score(docs, WORD_TOKENS), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for i, expected in brute.base_scores(texts).items():
        assert found[i][:4] == expected[:4]
        assert found[i][4] == pytest.approx(expected[4], rel=1e-9)
        assert found[i][5] < 0


def test_attention_beats_word_shares_on_held_out_texts():
    pick = np.random.default_rng(1)
    # Two languages without common ids: what came before tells which one goes on.
    texts = [np.append(pick.integers(0, 50, 80) + 50 * (i % 2), 100) for i in range(120)]
    model = scoring.Attention(100).fit(texts[:80], epochs=6)
    held = model.score(texts[80:]).sum() / (40 * 81)
    assert held > -np.log10(75)
    p = np.array([model.topics.sum(0)])
    assert p == pytest.approx(np.ones_like(p), rel=1e-4)


def test_each_token_is_scored_once():
    model = scoring.Attention(30)
    texts = [np.arange(n) % 30 for n in (0, 1, 31, 32, 33, 64, 100)]
    seen = np.zeros(len(texts), int)
    for _, _, scored, text in model.windows(texts):
        np.add.at(seen, text, scored.sum(1))
    assert seen.tolist() == [len(t) for t in texts]


def test_attention_learns_from_all_training_texts(spark, monkeypatch):
    """What stands only outside the texts of the start, or in a text beyond 64 KiB, counts for held-out texts."""
    monkeypatch.setattr(scoring, "TRAIN_TEXTS", 2)
    ids = [i for i in range(400) if not scoring.held_out(i)]
    held = next(i for i in range(400) if scoring.held_out(i))
    common = [(i, t) for i, t in zip(ids[:30], sentences(30, 4), strict=True)]
    rare = "ωμέγα θάλασσα ουρανός "
    long = (ids[30], "\n".join(sentences(400, 6)) + "\n" + rare * 1_000)
    short = [(i, rare * 3) for i in ids[31:61]]
    assert len(long[1].encode()) > 1 << 16
    found = []
    for more in ([], [long], short):
        rows = spark.createDataFrame([*common, *more, (held, rare * 5)], "doc_id long, text string").repartition(3)
        found.append(by_id(scoring.score(rows, WORD_TOKENS), "score")[held][0])
    assert found[1] > 0.8 * found[0] and found[2] > 0.8 * found[0]


# ---------------------------------------------------------------- all of them


def test_no_rows(spark, nothing):
    assert packing.pack(nothing, WORD_TOKENS).count() == 0
    assert bpe.encode_and_decode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0
    assert sharding.assign(nothing, [1.0] * 3).count() == 0
    assert quality.judge(nothing).count() == 0
    assert licenses.scan(nothing).count() == 0
    assert near_duplicates.deduplicate(nothing).count() == 0
    assert scoring.score(nothing, WORD_TOKENS).count() == 0


def test_clashing_names_do_no_harm(spark, texts):
    names = ["words", "lines", "_row", "node", "size", "shard", "bucket", "ids", "_text", "_n", "kept", "language"]
    rows = [(i, t, *["x"] * len(names)) for i, t in texts[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert sharding.assign(docs, [1.0] * 3).count() == 20
    assert quality.judge(docs).count() == 20
    assert quality.keep_good(docs).columns == docs.columns
    assert near_duplicates.keep_one(docs).columns == docs.columns
    assert repeats.remove_repeats(docs).columns == docs.columns
    assert packing.pack(docs, WORD_TOKENS).select("doc_id").distinct().count() == 20
    assert licenses.scan(docs).count() == 20

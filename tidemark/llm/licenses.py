"""License scans: k-gram hits of documents on templates, voted by diagonal and verified on the text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    in_small_batches,
    lower_ascii,
    rolling,
    slices,
    span_hashes,
    text_buffers,
    text_or_empty,
    tidy,
    word_spans,
)

# The phrases that carry a label by themselves.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Statements and notices of public licenses, as (name, label, text).
TEMPLATES = (
    ("mit statement", "mit", "released under the mit license"),
    ("apache statement", "apache", "licensed under the apache license version 2 0"),
    ("gpl statement", "gpl", "this work is licensed under the gnu general public license version 3"),
    ("cc by nc statement", "cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc by statement", "cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    (
        "mit notice",
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    (
        "apache notice",
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    (
        "gpl notice",
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    (
        "bsd notice",
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    # The other members of the Creative Commons family, and the short forms of all.
    *[
        (f"{label} form {i}", label, form)
        for label, short, long in (
            ("cc-by", "", ""),
            ("cc-by-nc", "nc ", "noncommercial "),
            ("cc-by-sa", "sa ", "sharealike "),
            ("cc-by-nd", "nd ", "noderivatives "),
            ("cc-by-nc-sa", "nc sa ", "noncommercial sharealike "),
            ("cc-by-nc-nd", "nc nd ", "noncommercial noderivatives "),
        )
        for i, form in enumerate(
            (
                f"licensed under cc by {short}4 0",
                f"license cc by {short}4 0",
                f"this work is licensed under a creative commons attribution {long}4 0 international license",
            )
        )
    ],
)
# Words that name a license; a template's must all stand in the span. Labels name no version, so numbers may differ.
NAMING = frozenset("mit apache gnu general public creative commons attribution cc nc sa nd".encode().split())
# Terms that change the license wherever they are put in, by the words that say them.
TERMS = {
    **dict.fromkeys((b"nc", b"noncommercial", b"commercial"), "nc"),
    **dict.fromkeys((b"sa", b"sharealike", b"alike"), "sa"),
    **dict.fromkeys((b"nd", b"noderivatives", b"noderivs", b"derivatives"), "nd"),
}
# Templates with fewer words must have the word license, too.
SHORT = 6
K = 4
# Diagonals at most so far apart belong to one occurrence with words put in or left out.
NEIGHBOURS = 2
# Share of a template's words that must stand in order in the span.
COVERED = 0.8
SLICE_BYTES = 8 << 20
# Candidate keys are first met as one of so many bits: the broadcast side never has more rows than this.
KEY_BUCKETS = 1 << 18

# Digits, a-z after lower-casing, and all bytes of characters beyond ASCII.
_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[0x30:0x3A] = True
_WORD_BYTES[0x61:0x7B] = True
_WORD_BYTES[0x80:] = True


def _words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends, number of words up to each text border, and word hashes."""
    data, offsets = text_buffers(column)
    data = lower_ascii(data)
    starts, ends, upto = word_spans(data, offsets, _WORD_BYTES)
    return data, starts, ends, upto, span_hashes(data, starts, ends)


def _hash_words(text: str) -> np.ndarray:
    import pyarrow as pa

    return _words(pa.array([text]))[4]


def words_of(text: str) -> list[bytes]:
    import pyarrow as pa

    data, starts, ends, _, _ = _words(pa.array([text]))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _key(df: DataFrame, text: str) -> DataFrame:
    body = text_or_empty(text)
    return df.select("*", F.xxhash64(body).alias("_k1"), F.xxhash64(F.lit(1), body).alias("_k2"))


def base_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES) -> DataFrame:
    """Per row: n_words, n_base, first_word, last_word and base_labels; places are checked word by word."""
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("_k1", T.LongType()),
        T.StructField("_k2", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")],
        T.StructField("base_labels", T.ArrayType(T.StringType())),
    ]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        wanted = [(_hash_words(p), [w.encode() for w in p.split()], label) for p, label in phrases]
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, text=3):
                data, starts, ends, upto, hashes = _words(part.column(3))
                found: dict[int, list[tuple[int, str]]] = {}
                for phrase, words, label in wanted:
                    n = len(phrase)
                    if len(hashes) < n:
                        continue
                    hit = np.ones(len(hashes) - n + 1, bool)
                    for i in range(n):
                        hit &= hashes[i : len(hashes) - n + 1 + i] == phrase[i]
                    at = np.flatnonzero(hit)
                    row = np.searchsorted(upto, at, side="right") - 1
                    for i, r in zip(at.tolist(), row.tolist(), strict=True):
                        same = all(data[starts[i + j] : ends[i + j]].tobytes() == words[j] for j in range(n))
                        if same and i + n <= upto[r + 1]:
                            found.setdefault(r, []).append((i - int(upto[r]), label))
                rows = range(part.num_rows)
                places = [found.get(r, []) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        part.column(2),
                        pa.array(np.diff(upto).astype(np.int64)),
                        pa.array([len(p) for p in places], pa.int64()),
                        pa.array([min(p)[0] if p else None for p in places], pa.int64()),
                        pa.array([max(p)[0] if p else None for p in places], pa.int64()),
                        pa.array([sorted({label for _, label in p}) for p in places], pa.list_(pa.string())),
                    ],
                    names=[f.name for f in fields],
                )

    source = _key(docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text")), "_text")
    return source.select(key, "_k1", "_k2", "_text").mapInArrow(tidy(run), T.StructType(fields))


def template_grams(docs: DataFrame, templates=TEMPLATES, k: int = K) -> DataFrame:
    """Every k-gram hash of every template with its position; a table whose size is that of the template list."""
    rows = [
        (int(np.int64(h)), t, i)
        for t, (_, _, text) in enumerate(templates)
        for i, h in enumerate(rolling(_hash_words(text), k).view(np.int64).tolist())
    ]
    return docs.sparkSession.createDataFrame(rows, "_hash long, template int, t_pos int")


def gram_hits(docs: DataFrame, text: str = "text", templates=TEMPLATES, k: int = K) -> DataFrame:
    """All rolling k-gram hashes of all texts, joined to the template positions. Equal texts count once."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                _, _, _, upto, hashes = _words(part.column(1))
                grams = rolling(hashes, k).view(np.int64)
                row = np.repeat(np.arange(part.num_rows), np.diff(upto))[: len(grams)]
                place = np.arange(len(grams)) - upto[:-1][row]
                whole = place + k <= np.diff(upto)[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row[whole])),
                        pa.array(place[whole].astype(np.int64)),
                        pa.array(grams[whole]),
                    ],
                    names=["_k1", "pos", "_hash"],
                )

    source = docs.select(text_or_empty(text).alias("_text")).select(F.xxhash64("_text").alias("_k1"), "_text")
    grams = source.mapInArrow(tidy(run), "_k1 long, pos long, _hash long")
    hits = grams.join(F.broadcast(template_grams(docs, templates, k)), "_hash")
    return hits.select("_k1", "template", "t_pos", "pos").distinct()


def voted_spans(hits: DataFrame, k: int = K, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Hits summed by offset diagonal, diagonals that lie close together merged into one candidate span."""
    diagonals = hits.groupBy("_k1", "template", (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("first"), (F.max("pos") + k).alias("last")
    )
    order = Window.partitionBy("_k1", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    # An occurrence further down the text starts a new group even if its diagonal is close by.
    apart = F.coalesce((gap > neighbours).cast("int"), F.lit(1))
    grouped = diagonals.withColumn("group", F.sum(apart).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("_k1", "template", "group").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def covered(template: list[bytes], span: list[bytes]) -> float:
    """The share of the template's words that stand in the span in the same order."""
    return _fit(template, span)[0]


def _fit(template: list[bytes], span: list[bytes]) -> tuple[float, set[bytes], list[bytes]]:
    """The share of ``covered``, the template's words that are missing, and the span from first to last match."""
    from difflib import SequenceMatcher

    blocks = [b for b in SequenceMatcher(None, template, span, autojunk=False).get_matching_blocks() if b.size]
    have = {i for b in blocks for i in range(b.a, b.a + b.size)}
    missing = {w for i, w in enumerate(template) if i not in have}
    inside = span[blocks[0].b : blocks[-1].b + blocks[-1].size] if blocks else []
    return len(have) / max(1, len(template)), missing, inside


def names_it(template: list[bytes], missing: set[bytes], inside: list[bytes]) -> bool:
    """Whether the span names the template's license and not another one of its family."""
    must = NAMING | {b"license"} if len(template) < SHORT else NAMING
    if missing & must:
        return False
    family = b"cc" in template or b"attribution" in template
    terms = lambda words: {TERMS[w] for w in words if w in TERMS}
    return not family or terms(template) == terms(inside)


def verified_labels(docs: DataFrame, spans: DataFrame, text: str = "text", templates=TEMPLATES, share: float = COVERED) -> DataFrame:
    """Per text with a verified span: its keys, its labels, the best coverage and the spans found."""
    wanted = spans.groupBy("_k1").agg(F.collect_list(F.struct("template", "first", "last")).alias("_spans"))
    bucket = F.pmod(F.col("_k1"), F.lit(KEY_BUCKETS))
    some = wanted.select(bucket.alias("_bucket")).distinct()
    texts = _key(docs.select(text_or_empty(text).alias("_text")), "_text").withColumn("_bucket", bucket)
    met = texts.join(F.broadcast(some), "_bucket", "left_semi").join(wanted, "_k1")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shapes = [(label, words_of(body)) for _, label, body in templates]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = words_of(row["_text"])
                found = []
                for s in row["_spans"]:
                    label, shape = shapes[s["template"]]
                    first = max(0, s["first"] - len(shape))
                    score, missing, inside = _fit(shape, words[first : s["last"] + len(shape)])
                    if score >= share and names_it(shape, missing, inside):
                        found.append((label, score, s["first"], s["last"]))
                # Where spans of different licenses overlap, the best fit wins.
                found = [
                    f
                    for f in found
                    if not any(g[0] != f[0] and g[1] > f[1] and g[2] < f[3] and f[2] < g[3] for g in found)
                ]
                if found:
                    out.append(
                        {
                            "_k1": row["_k1"],
                            "_k2": row["_k2"],
                            "found": sorted({f[0] for f in found}),
                            "coverage": max(f[1] for f in found),
                            "spans": [{"label": f[0], "first_word": f[2], "end_word": f[3]} for f in sorted(found)],
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=arrow_schema)

    schema = T.StructType(
        [
            T.StructField("_k1", T.LongType()),
            T.StructField("_k2", T.LongType()),
            T.StructField("found", T.ArrayType(T.StringType())),
            T.StructField("coverage", T.DoubleType()),
            T.StructField(
                "spans",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("label", T.StringType()),
                            T.StructField("first_word", T.LongType()),
                            T.StructField("end_word", T.LongType()),
                        ]
                    )
                ),
            ),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema)
    one = met.select("_k1", "_k2", "_text", "_spans").mapInArrow(tidy(run), schema)
    return one.groupBy("_k1", "_k2").agg(
        F.first("found").alias("found"), F.first("coverage").alias("coverage"), F.first("spans").alias("spans")
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES, k: int = K) -> DataFrame:
    """Per row: the base counts, base_labels, labels, score and the verified spans.

    score is 1 where a base phrase stands, else the best coverage of a verified template, else 0. Null or empty
    text: no words, no labels, score 0. Null and repeated keys: row by row; equal texts are voted on once. No rows:
    no rows. Other columns are not read, whatever their names. Texts are read whole.
    """
    base = base_scan(in_small_batches(docs), key, text, phrases)
    found = verified_labels(docs, voted_spans(gram_hits(docs, text, templates, k), k), text, templates)
    joined = base.join(found, ["_k1", "_k2"], "left")
    labels = F.sort_array(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return joined.select(
        key,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array("base_labels"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
        "spans",
    )



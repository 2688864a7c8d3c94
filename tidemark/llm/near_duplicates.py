"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    SPACED_WORD_BYTES,
    in_small_batches,
    lower_ascii,
    mix,
    rolling,
    saved,
    slices,
    span_hashes,
    text_buffers,
    tidy,
    word_spans,
)
from tidemark.llm.components import components

SHINGLE = 5
# 32 bands of 6 coordinates miss a pair of similarity 0.85 about once in four million, one of 0.8 once in 17,000.
BANDS, ROWS = 32, 6
SLICE_BYTES = 1 << 20
# Buckets up to this size give all their pairs. Of larger ones the links to one member come first, then only what
# is still apart is compared, block by block.
SMALL_BUCKET = 32
BLOCK = 400
# Pairs whose signatures agree less, by so much of similarity, are not worth an exact look: over five standard errors.
ESTIMATE_SLACK = 0.15
ID_BUCKETS = 1 << 18


def _permute(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit integers (the murmur finalizer); changes ``x`` in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(shingles: np.ndarray, borders: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """``count`` MinHash coordinates of each set ``shingles[borders[i]:borders[i+1]]``, none of them empty.

    One permutation scatters the shingles over the circle of 32-bit integers; coordinate k reads the second
    permutation shifted by k along that circle. Two permutations so give every coordinate.
    """
    scattered = _permute((shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32))
    out = np.empty((len(borders) - 1, count), np.uint32)
    for k in range(count):
        out[:, k] = np.minimum.reduceat(_permute(scattered + np.uint32(k)), borders[:-1])
    return out


def shingle_sets(column, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow array; fewer words than k make one shingle."""
    data, offsets = text_buffers(column)
    data = lower_ascii(data)
    starts, ends, upto = word_spans(data, offsets, SPACED_WORD_BYTES)
    words = span_hashes(data, starts, ends)
    grams = rolling(words, k)
    out = []
    for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(mix(rolling(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sketched(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    fields = [
        T.StructField("id", docs.schema[key].dataType),
        T.StructField("n", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                sets = shingle_sets(part.column(1), k)
                sizes = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(sizes)
                keys = np.zeros((len(sets), BANDS), np.int64)
                sketches = [b""] * len(sets)
                digests = np.zeros((len(sets), 2), np.uint64)
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    borders = np.concatenate([[0], np.cumsum(sizes[some])])
                    found = signatures(flat, borders)
                    for j, salt in enumerate((0x1B873593, 0xCC9E2D51)):
                        digests[some, j] = np.add.reduceat(mix(flat ^ np.uint64(salt)), borders[:-1])
                    for band in range(BANDS):
                        value = np.full(len(some), band, np.uint64)
                        for row in range(ROWS):
                            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + found[:, band * ROWS + row])
                        keys[some, band] = value.view(np.int64)
                    for i, sketch in zip(some.tolist(), found.astype(np.uint8), strict=True):
                        sketches[i] = sketch.tobytes()
                width = np.arange(len(sets) + 1, dtype=np.int32) * BANDS
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes),
                        pa.array(digests[:, 0].view(np.int64)),
                        pa.array(digests[:, 1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(width), pa.array(keys.ravel())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=[f.name for f in fields],
                )

    return docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("_text")).mapInArrow(tidy(run), T.StructType(fields))


def _full_sets(docs: DataFrame, nodes: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """The full shingle set of each wanted document. A bounded list of id buckets thins out the texts before the join."""
    bucket = F.pmod(F.xxhash64("node"), F.lit(ID_BUCKETS))
    texts = docs.select(F.col(key).alias("node"), F.col(text).cast("string").alias("_text"))
    some = texts.withColumn("_b", bucket).join(F.broadcast(nodes.select(bucket.alias("_b")).distinct()), "_b", "left_semi")
    met = some.join(nodes, "node", "left_semi").select("node", "_text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                sets = shingle_sets(part.column(1), k)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "shingles"]
                )

    return met.mapInArrow(tidy(run), T.StructType([T.StructField("node", docs.schema[key].dataType), T.StructField("shingles", T.ArrayType(T.LongType()))]))


def _alike(inner: Column, left: Column, right: Column, percent: int) -> Column:
    """Whether ``100 * |A and B| >= percent * |A or B|``, in whole numbers."""
    return 100 * inner >= percent * (left + right - inner)


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = saved(_full_sets(docs, nodes, key, text, k))
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    met = pairs.join(left, "a").join(right, "b")
    inner = F.size(F.array_intersect("sa", "sb"))
    return met.where(_alike(inner, F.size("sa"), F.size("sb"), percent)).select("a", "b").distinct()


def _agreeing(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs whose signatures agree in at least that share of coordinates (one byte of each is compared)."""

    @F.arrow_udf("double")
    def share(x, y):
        import pyarrow as pa

        if not len(x):
            return pa.array([], pa.float64())
        a = np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), -1)
        b = np.frombuffer(b"".join(y.to_pylist()), np.uint8).reshape(len(y), -1)
        return pa.array((a == b).mean(1))

    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(share("x", "y") >= least).select("a", "b").distinct()


def links(docs: DataFrame, sketched: DataFrame, key: str, text: str, percent: int, k: int = SHINGLE) -> DataFrame:
    """Confirmed links between documents with different sets, enough of them to connect every component.

    Of each distinct set only its smallest id takes part. Buckets of a few members are compared pair by pair. In a
    larger bucket all are first compared with its smallest member; whoever is still in another component is then
    compared with the rest in blocks of full sets: each set goes to a block once, not once a pair, and of the links
    found only those come back that join components.
    """
    least = percent / 100 - ESTIMATE_SLACK
    nodes = saved(
        sketched.where("n > 0 AND id IS NOT NULL")
        .groupBy("d1", "d2", "n")
        .agg(F.min("id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .select("node", "bands", "sketch")
    )
    sketches = nodes.select("node", "sketch")
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub")).where("size > 1")
    members = saved(banded.join(sizes, "bucket"))
    small = members.where(F.col("size") <= SMALL_BUCKET)
    pairs = small.select("bucket", F.col("node").alias("a")).join(small.select("bucket", F.col("node").alias("b")), "bucket")
    large = members.where(F.col("size") > SMALL_BUCKET)
    stars = large.where("node > hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    first = pairs.where("a < b").select("a", "b").unionByName(stars).distinct()
    confirmed = saved(_confirmed(saved(_agreeing(first, sketches, least)), docs, key, text, k, percent))
    if large.isEmpty():
        return confirmed
    joined = large.join(components(confirmed), "node", "left").select(
        "bucket", "size", "node", F.coalesce("component", "node").alias("component")
    )
    apart = joined.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    open_rows = saved(joined.join(apart.select("bucket"), "bucket", "left_semi"))
    if open_rows.isEmpty():
        return confirmed
    sets = _full_sets(docs, open_rows.select("node").distinct(), key, text, k)
    dealt = open_rows.join(sets, "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    dealt = dealt.select(
        "bucket",
        "node",
        "component",
        "shingles",
        "block",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )

    def compare(group):
        import pandas as pd

        node, label, block = (group[c].to_numpy() for c in ("node", "component", "block"))
        label = np.unique(label, return_inverse=True)[1]
        sets = [np.asarray(x) for x in group["shingles"]]
        size = np.array([len(x) for x in sets])
        number = np.unique(np.concatenate(sets), return_inverse=True)[1]
        borders = np.concatenate([[0], np.cumsum(size)])
        crossing = group["i"].iloc[0] != group["j"].iloc[0]
        mark = np.zeros(number.max() + 1, np.int64)
        out = []
        for r in range(len(group) - 1):
            far = label != label[r]
            far[: r + 1] = False
            if crossing:
                far &= block != block[r]
            if not far.any():
                continue
            own = number[borders[r] : borders[r + 1]]
            mark[own] = 1
            inner = np.add.reduceat(mark[number], borders[:-1])
            mark[own] = 0
            # One link to each other component is enough; from then on the two are one.
            for h in np.flatnonzero(far & (100 * inner >= percent * (size + size[r] - inner))).tolist():
                if label[h] != label[r]:
                    out.append((min(node[r], node[h]), max(node[r], node[h])))
                    label[label == label[h]] = label[r]
        return pd.DataFrame(out, columns=["a", "b"])

    kind = docs.schema[key].dataType.simpleString()
    return confirmed.unionByName(dealt.groupBy("bucket", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}"))


def deduplicate(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """Per row: n_shingles, component_id (the smallest id reachable by links, itself included) and kept.

    Documents with equal sets are linked at once by the digest of the set; the others by ``links``. No words or null
    text: an empty set, linked with nothing. Rows that share an id are one document. A null id is linked with
    nothing, its component is null and it is kept. No rows: no rows. Other columns are not read. Texts are whole.
    """
    sketched = saved(_sketched(in_small_batches(docs), key, text, k))
    found = components(links(docs, sketched, key, text, percent, k))
    equal = (
        sketched.where("n > 0 AND id IS NOT NULL")
        .groupBy("d1", "d2", "n")
        .agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    whole = equal.join(found, "node", "left").select("d1", "d2", "n", F.coalesce("component", "node").alias("of_set"))
    rows = sketched.select("id", "n", "d1", "d2").join(whole, ["d1", "d2", "n"], "left")
    rows = rows.join(found.select(F.col("node").alias("id"), F.col("component").alias("of_id")), "id", "left")
    component = F.when(F.col("n") > 0, F.least("of_set", "of_id", "id")).otherwise(F.col("id"))
    return rows.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id, all columns kept.

    Rows that repeat an id are one document, of which one row stays. Rows with a null id stay. Only texts whose id
    shares a bucket with an id that goes are shuffled.
    """
    judged = saved(deduplicate(docs, percent, key, text).select(F.col(key).alias("_id"), "kept"))
    gone = judged.where("NOT kept").select("_id").distinct()
    again = judged.where("kept AND _id IS NOT NULL").groupBy("_id").count().where("count > 1").select("_id")
    bucket = F.pmod(F.xxhash64("_id"), F.lit(ID_BUCKETS)).alias("_bucket")
    touched = F.broadcast(gone.unionByName(again).select(bucket).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key).alias("_id"))
    rows = rows.select("*", bucket)
    sure = rows.join(touched, "_bucket", "left_anti")
    open_rows = rows.join(touched, "_bucket", "left_semi").join(gone, "_id", "left_anti")
    if not again.isEmpty():
        twice = open_rows.join(again, "_id", "left_semi").groupBy("_id").agg(F.first("_row").alias("_row"))
        open_rows = open_rows.join(again, "_id", "left_anti").select("_id", "_row").unionByName(twice)
    return sure.select("_row.*").unionByName(open_rows.select("_row.*"))

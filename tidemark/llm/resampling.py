"""Importance resampling towards a target: weights from arrays of gains, winners by weighted medians of medians."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    PLAIN_WORD_BYTES,
    in_small_batches,
    lower_ascii,
    slices,
    stored,
    text_buffers,
    text_or_empty,
    tidy,
    word_spans,
)

BUCKETS = 10_000
FEWEST_WORDS = 20
SLICE_BYTES = 1 << 20
# Words up to so many bytes are hashed side by side, the few longer ones one by one.
SIDE_BY_SIDE = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Unsigned CRC-32 of each ``data[start:end]``, or its continuation where the CRC of what stands before is given."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    sizes, at = lengths[order], starts[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32) if before is None else ~before[order]
    for step in range(int(min(sizes[0], SIDE_BY_SIDE)) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -step, side="left"))
        state[:live] = _CRC[(state[:live] ^ data[at[:live] + step]) & 0xFF] ^ (state[:live] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for i in order[: int(np.searchsorted(-sizes, -SIDE_BY_SIDE, side="left"))]:
        out[i] = zlib.crc32(data[starts[i] + SIDE_BY_SIDE : ends[i]].tobytes(), int(out[i]))
    return out


def features(column, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an Arrow array of texts: the bucket of every run of 1 to ``longest`` words, the text each run is in, and the
    number of words of each text."""
    data, offsets = text_buffers(column)
    data = lower_ascii(data)
    starts, ends, borders = word_spans(data, offsets, PLAIN_WORD_BYTES)
    words = np.diff(borders)
    owner = np.repeat(np.arange(len(words)), words)
    space = np.array([32], np.uint8)
    crc = crc_spans(data, starts, ends)
    found, owners = [crc], [owner]
    for size in range(2, longest + 1):
        # A run ends in the text it begins in.
        inside = np.flatnonzero(owner[: len(owner) - size + 1] == owner[size - 1 :])
        last = inside + size - 1
        spaced = crc_spans(space, np.zeros(len(inside), np.int64), np.ones(len(inside), np.int64), crc[inside])
        grown = np.zeros(len(crc), np.uint32)
        grown[inside] = crc_spans(data, starts[last], ends[last], spaced)
        crc = grown
        found.append(crc[inside])
        owners.append(owner[inside])
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(owners), words


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket. Tasks send one row per bucket, whatever they read."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, text=0):
                total += np.bincount(features(part.column(0), longest, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"])

    per_task = in_small_batches(docs).select(F.col(text).cast("string")).mapInArrow(tidy(run), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of how much likelier the target is to draw it), with one added to every count."""
    n, of_source, of_target = len(source), int(source.sum()), int(target.sum())
    ratios = [
        math.floor(1000 * math.log(float(t + 1) * float(of_source + n) / (float(s + 1) * float(of_target + n))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ]
    return np.array(ratios, np.int64)


def noise(seed: int, name: str) -> int:
    """floor(1000 * a Gumbel draw) that depends on the seed and the row's name only."""
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(
    docs: DataFrame, gain: np.ndarray, seed: int, longest: int = 1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``ref`` (a number of the row), key, n_words, n_features, weight (sum of gains) and score (weight plus noise)."""
    buckets = len(gain)
    schema = T.StructType(
        [
            T.StructField("ref", T.LongType()),
            T.StructField(key, docs.schema[key].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score")],
        ]
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES, text=3):
                bucket, owner, words = features(part.column(3), longest, buckets)
                # Sums of integers below 2**53 in doubles are exact.
                weight = np.bincount(owner, gain[bucket], minlength=len(words)).astype(np.int64)
                drawn = np.array([noise(seed, name) for name in part.column(2).to_pylist()], np.int64)
                numbers = [words, np.bincount(owner, minlength=len(words)), weight, weight + drawn]
                columns = [part.column(0), part.column(1), *[pa.array(x, pa.int64()) for x in numbers]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    source = in_small_batches(docs).select(
        F.monotonically_increasing_id().alias("ref"),
        F.col(key).alias(key),
        text_or_empty(F.col(key)).alias("_name"),
        F.col(text).cast("string").alias("_text"),
    )
    return source.mapInArrow(tidy(run), schema)


# The order of the draw: highest score, then smallest key, rows without key last; rows that tie in both by number.
_ORDER = ("lost", "unnamed", "name", "ref")


def _order(key: str) -> list[Column]:
    unnamed = F.col(key).isNull().cast("int")
    return [c.alias(n) for c, n in zip((-F.col("score"), unnamed, F.col(key), F.col("ref")), _ORDER, strict=True)]


def _place(row: tuple, like: DataFrame) -> Column:
    return F.struct(*[F.lit(v).cast(like.schema[c].dataType).alias(c) for c, v in zip(_ORDER, row, strict=True)])


def _medians(sided: DataFrame) -> list[tuple[int, int, tuple]]:
    """Per partition and side of the last pivot: the side, how many rows it holds, and their median row."""
    schema = T.StructType([T.StructField("side", T.IntegerType()), T.StructField("n", T.LongType()), *sided.select(*_ORDER).schema])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        for side in (0, 1, 2):
            own = rows.filter(pc.equal(rows["side"], side)).drop_columns("side")
            if own.num_rows:
                order = pc.sort_indices(own, [(c, "ascending") for c in _ORDER])
                middle = own.take(order.slice((own.num_rows - 1) // 2, 1)).to_batches()[0]
                head = [pa.array([side], pa.int32()), pa.array([own.num_rows], pa.int64())]
                yield pa.RecordBatch.from_arrays([*head, *middle.columns], names=schema.names)

    rows = sided.select("side", *_ORDER).mapInArrow(tidy(run), schema).collect()
    return [(r["side"], r["n"], tuple(r[c] for c in _ORDER)) for r in rows]


def _weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    """The least row such that partitions with at least half of all rows have a median up to it."""
    total, passed = sum(n for n, _ in medians), 0
    for n, row in sorted(medians, key=lambda m: tuple((v is None, v) for v in m[1])):
        passed += n
        if 2 * passed >= total:
            return row
    raise ValueError("no medians")


def cutoff(scores: DataFrame, rank: int, key: str = "doc_id") -> Column:
    """Whether a row of ``scores`` is among the first ``rank`` (1 or more, at most all rows) in the order of the draw.

    Each partition reports the median and the number of its remaining rows. The median of these medians, weighted by
    the numbers, is the pivot: at least a quarter of the remaining rows stand on either side of it (up to rounding),
    so the side without the cutoff goes for good, until the pivot is the cutoff row itself. One job a round counts
    both sides of a pivot and finds their medians. Two rows per partition reach the driver; a task holds the order
    columns of its own remaining rows. Whenever few rows remain, these alone are written anew, so that all rounds
    together read a small multiple of the rows.
    """
    remaining = written = scores.select(*_order(key))
    medians = [(n, row) for _, n, row in _medians(written.withColumn("side", F.lit(0)))]
    size = left = sum(n for n, _ in medians)
    if not 1 <= rank <= left:
        raise ValueError("rank must be between 1 and the number of rows")
    while True:
        pivot = _weighted_median(medians)
        here, there = F.struct(*_ORDER), _place(pivot, written)
        sided = remaining.withColumn("side", F.when(here < there, 0).when(here == there, 1).otherwise(2))
        found = _medians(sided)
        less = sum(n for side, n, _ in found if side == 0)
        equal = sum(n for side, n, _ in found if side == 1)
        if less < rank <= less + equal:
            return F.struct(*_order(key)) <= there
        kept = 0 if rank <= less else 2
        rank -= 0 if kept == 0 else less + equal
        medians = [(n, row) for side, n, row in found if side == kept]
        left = sum(n for n, _ in medians)
        remaining = remaining.where(here < there if kept == 0 else here > there)
        if left * 8 < size:
            remaining = stored(remaining)
            size = left


def ranked(winners: DataFrame, key: str = "doc_id") -> DataFrame:
    """``ref, rank`` of the rows, 1 first, in the order of the draw: range partitions sort their own rows, and the
    counts of the partitions before shift the numbers."""
    ordered = winners.select(*_order(key)).orderBy(*_ORDER)
    sorted_rows = stored(ordered.select("ref", F.monotonically_increasing_id().alias("at")))
    part = F.shiftrightunsigned("at", 33)
    sizes = {r["part"]: r["n"] for r in sorted_rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, shifts = 1, []
    for p in sorted(sizes):
        shifts.append((p, before))
        before += sizes[p]
    table = winners.sparkSession.createDataFrame(shifts, "part long, before long")
    numbered = sorted_rows.withColumn("part", part).join(F.broadcast(table), "part")
    return numbered.select("ref", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    seed: int = 2024,
    longest: int = 1,
    buckets: int = BUCKETS,
    fewest_words: int = FEWEST_WORDS,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Every row's key, n_features, weight, score and rank: the draw of ``percent`` of the rows that have at least
    ``fewest_words`` words, without replacement, with odds in proportion to how much likelier the target is to hold
    the row's features than ``docs`` are. Undrawn rows have a null rank.

    Features are all runs of 1 to ``longest`` words in ``buckets`` buckets; counts cover all rows of both tables. A
    row's weight is looked up in one array with a gain per bucket. Adding Gumbel noise to log weights and taking the
    highest is such a draw; ``cutoff`` finds the last winner without a sort of the losers.

    Null or empty text: no features, weight 0, not drawn. A null key counts as the empty name for the noise and comes
    last among ties; repeated keys have equal noise and are drawn row by row. No rows, or too few to draw one: no
    ranks. An empty target: gains from the added ones alone. Other columns are not read. Whole texts are counted.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    scores = stored(weights(docs, gain, seed, longest, key, text))
    able = scores.where(F.col("n_words") >= fewest_words)
    drawn = percent * able.count() // 100
    if drawn:
        ranks = ranked(able.where(cutoff(able, drawn, key)), key)
        scores = scores.join(ranks, "ref", "left")
    else:
        scores = scores.withColumn("rank", F.lit(None).cast("long"))
    return scores.select(key, "n_features", "weight", "score", "rank")

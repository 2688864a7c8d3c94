"""Helpers that the operators share: tables, text columns, checkpoints, rolling hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words: space and the five ASCII control characters from tab to carriage return.
NOT_WORD = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


# Rows go to Python tasks in batches of at most so many bytes, however long their texts are.
BATCH_BYTES = "4m"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session set to hand rows to Python in small batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, after which the task's memory goes back to the machine: Python workers
    live on for later stages, and what they only keep in reserve would add up."""

    def whole_task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole_task


def release_memory() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    # Of the C library; others have no such call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, lineage cut.

    The folder is the session's ``spark.checkpoint.dir``; only where none is set (tests, one machine) is a
    temporary one made.
    """
    spark = df.sparkSession
    _checkpoint_folder(spark)
    return df.checkpoint(eager=True)


def _checkpoint_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the checkpoint folder, lineage cut: for what is large or read in part,
    since its readers take only the columns and row groups they need."""
    path = f"{_checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Tables of at most so many short rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, which are counted for it; else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread(df: DataFrame, mb_per_partition: int, bytes_column: Column, least: int = 1) -> int:
    """How many partitions of about ``mb_per_partition`` the summed ``bytes_column`` fills."""
    total = df.agg(F.sum(bytes_column.cast("long")).alias("n")).first()["n"] or 0
    return max(least, -(-total // (mb_per_partition << 20)))


def texts_by_hash(rows: DataFrame, text: str, count: int, *hashed: str) -> list[str]:
    """Texts of the ``count`` rows with the least hash of the given columns. Only hashes are ranked, so that tasks do
    not send whole texts to the driver from which it then takes a few."""
    keyed = rows.select(F.xxhash64(*hashed).alias("h"), F.col(text).alias("t"))
    wanted = [r["h"] for r in keyed.select("h").distinct().orderBy("h").limit(count).collect()]
    found = keyed.where(F.col("h").isin(wanted)).limit(count).collect()
    return [r["t"] for r in sorted(found, key=lambda r: (r["h"], r["t"]))]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        steps = np.full(size, BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
        steps[1:] = np.uint64(pow(int(BASE), -1, 1 << 64))
        _inverse = np.multiply.accumulate(steps)
    return _powers[:n], _inverse[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``: polynomial prefix sums modulo 2**64, mixed with the length."""
    powers, inverse = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` word hashes; entry i covers words i to i+k-1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= BASE
        out += words[i : i + n]
    return mix(out)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array as one vector, and its n+1 offsets; a null is an empty text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def column_slices(column, max_bytes: int):
    """Borders of parts of an Arrow text array that hold about ``max_bytes`` each (one long text may hold more)."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + max_bytes, side="right")))
        yield start, end
        start = end


def slices(batch, max_bytes: int, text: int = 1):
    """Parts of an Arrow batch whose text column holds about ``max_bytes`` each."""
    for start, end in column_slices(batch.column(text), max_bytes):
        yield batch.slice(start, end - start)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z turned into a-z and all others kept."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of word bytes, none across texts, and the number of words up to each text border."""
    inside = is_word[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = inside[first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


SPACED_WORD_BYTES = np.ones(256, bool)
SPACED_WORD_BYTES[[32, 9, 10, 11, 12, 13]] = False

# Words of letters, digits and all that is not ASCII, in lower-cased text.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_WORD_BYTES = np.zeros(256, bool)
PLAIN_WORD_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

"""Packing token sequences without padding: power-of-two pieces, bucketed by length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import in_small_batches, slices, tidy
from tidemark.llm.words import CACHED_CHUNKS, WordTokens, with_ends

MAX_LENGTH = 2048
END_ID = 1
# Texts handled at once in a task.
SLICE_BYTES = 1 << 20


def power_of_two_pieces(n: int, longest: int = MAX_LENGTH) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens: as many of the longest as fit, then the binary digits of
    the rest from the highest down. Every length is a power of two and every token is in one piece."""
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest piece must be a power of two")
    out = [(start, longest) for start in range(0, n - n % longest, longest)]
    start, rest = n - n % longest, n % longest
    while rest:
        length = 1 << (rest.bit_length() - 1)
        out.append((start, length))
        start, rest = start + length, rest - length
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    max_length: int = MAX_LENGTH,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    cached_chunks: int = CACHED_CHUNKS,
) -> DataFrame:
    """One row per sequence: a power-of-two piece of one document, so nothing is padded and none crosses documents.

    Columns: key, start and length (tokens of the document), ids_crc32, doc_tokens, sequence_id, offset (always 0:
    a sequence is one piece), bucket (log2 of the length) and, with ``with_ids``, ids. Batches of equal length are
    read from one bucket; ``write_buckets`` lays the sequences out that way. No shuffle takes place.

    ``cached_chunks`` bounds what a task remembers of the tokenizer's work; it changes time and memory only.

    Null or empty text: the single end id, one piece of length 1. Repeated rows and null keys: packed row by row.
    No rows: no rows. Other columns are not read, whatever their names. A very long text is cut into many pieces.
    """
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tokens = WordTokens(tokenizer, cached_chunks)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                rows, starts, lengths, crcs, totals, ids = [], [], [], [], [], []
                encoded, borders = tokens.encode(part.column(1))
                encoded, borders = with_ends(encoded, borders, end_id)
                whole = memoryview(encoded.astype("<u4", copy=False)).cast("B")
                for row, (first, last) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)):
                    for start, length in power_of_two_pieces(last - first, max_length):
                        piece = whole[4 * (first + start) : 4 * (first + start + length)]
                        rows.append(row)
                        starts.append(start)
                        lengths.append(length)
                        crcs.append(zlib.crc32(piece))
                        totals.append(last - first)
                        if with_ids:
                            ids.append(piece)
                sizes = np.array(lengths, np.int64)
                columns = [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes),
                    pa.array(crcs, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(np.log2(np.maximum(sizes, 1)).astype(np.int32)),
                ]
                if with_ids:
                    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    source = in_small_batches(docs).select(F.col(key).alias(key), F.col(text).cast("string").alias("_text"))
    pieces = source.mapInArrow(tidy(run), schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Write sequences as one folder per length, so that a reader draws equal-length batches from one folder."""
    sequences.write.mode("overwrite").partitionBy("bucket").parquet(path)

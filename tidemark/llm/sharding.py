"""Sharding by rendezvous hashing over weighted shards, with built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, text_or_empty


def _unit(key: Column, shard: int) -> Column:
    """A uniform draw from the open interval (0, 1) that depends on key and shard alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard).cast("long"), key), 11).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard that draws highest for this key: score ``weight / -ln(u)``, so a shard's share follows its weight.

    A further shard, or a higher weight of one, draws rows to that shard only; no row moves between the others.
    Equal scores go to the lower shard. A null key is a key like any other.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    draws = [
        F.struct((F.lit(float(w)) / -F.log(_unit(key, s))).alias("score"), F.lit(-s).alias("low"))
        for s, w in enumerate(weights)
    ]
    best = draws[0] if len(draws) == 1 else F.greatest(*draws)
    return (-best["low"]).cast("int")


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, size and checksum of each row, and its slot: a gapless number from 0 within the shard.

    ``grown_shard`` is the shard after one more of mean weight is added. Slots need no total order: each input
    partition numbers its own rows of a shard, and a small table of counts per shard and partition shifts them.
    So no task holds a whole shard, and a key that a third of the rows share (or a null) is no hot group.

    Null text: size 1 (none plus 1) and checksum 0. Null and repeated keys: all rows of a key share a shard, each
    has a slot of its own. No rows: no rows. Columns other than key and text are not read.
    """
    key_column = F.col(key).cast("string")
    grown = [*weights, sum(weights) / len(weights)]
    placed = docs.select(
        F.col(key).alias(key),
        (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).cast("long").alias("text_crc32"),
        rendezvous_shard(key_column, weights).alias("shard"),
        rendezvous_shard(key_column, grown).alias("grown_shard"),
        F.spark_partition_id().alias("_part"),
    )
    within = Window.partitionBy("shard", "_part").orderBy(F.col(key), F.col("text_crc32"))
    # Written once: rows and counts must see the same numbering even if an executor is lost between them.
    numbered = saved(placed.withColumn("_row", F.row_number().over(within) - 1))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        numbered.groupBy("shard", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(F.col("shard").alias("_shard"), F.col("_part").alias("_of"), "_before")
    )
    joined = numbered.join(counts, (F.col("shard") == F.col("_shard")) & (F.col("_part") == F.col("_of")))
    return joined.select(
        key, "size", "text_crc32", "shard", (F.col("_row") + F.col("_before")).cast("long").alias("slot"), "grown_shard"
    )

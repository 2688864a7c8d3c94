"""Incremental building blocks: watermark delta, latest row per key, append of unseen rows, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.clock import EPOCH, as_of_column

def watermark(target: DataFrame, mark_column: str) -> DataFrame:
    """One row: the newest mark of the target, 1970 when it is empty."""
    return target.agg(F.coalesce(F.max(mark_column), as_of_column(EPOCH)).alias("mark"))


def watermark_literal(target: DataFrame, mark_column: str) -> Column:
    """The watermark as a literal, which also prunes partitions. One value passes the driver."""
    micros = watermark(target, mark_column).select(F.unix_micros("mark")).first()[0]
    return F.timestamp_micros(F.lit(micros))


def incremental_delta(source: DataFrame, time_column: str, target: DataFrame, mark_column: str) -> DataFrame:
    """Source rows strictly newer than the target's watermark.

    The watermark is a scalar subquery: Spark runs it first and hands the value to the scan as a filter.
    """
    return source.filter(F.col(time_column) > watermark(target, mark_column).scalar())


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under ``order``; NULL keys form one group, as in SQL.

    Spark plans this top-1 with a partial limit before the shuffle, so every task hands over at most one
    row per key and a key that holds a third of all rows does not burden one reducer.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def anti_append(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Candidates whose key the existing table lacks; a NULL key is never found and always passes.

    The history's keys first shrink to those that the candidates have as well: a semi-join whose smaller side
    Spark broadcasts if it measures it as small, so that the history is then not shuffled. NULL keys of the
    history stay out.
    """
    known = existing.select(key).filter(F.col(key).isNotNull()).join(candidates.select(key), key, "left_semi")
    return candidates.join(known, key, "left_anti").select(*candidates.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` replace target rows of equal keys, or are added.

    One full outer join, so each side is evaluated once. Source keys have to be unique and not NULL; the plan checks it
    on the shuffle by key that the join needs anyway and fails, as a MERGE does. ``duplicate_or_null_keys`` tells which.
    """
    named = [f"_new_{k}" for k in keys]
    new = source.select(F.struct(*target.columns).alias("_row"), *[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)])
    unsound = F.count(F.lit(1)).over(Window.partitionBy(*named)) > 1
    for n in named:
        unsound = unsound | F.col(n).isNull()
    stop = F.raise_error(F.lit(f"upsert: source rows share a key or lack one ({', '.join(keys)})"))
    new = new.select(F.when(unsound, stop).otherwise(F.col("_row")).alias("_new"), *named)
    old = target.select(F.struct(*target.columns).alias("_old"), *[F.col(k).alias(f"_old_{k}") for k in keys])
    same = [F.col(f"_old_{k}") == F.col(f"_new_{k}") for k in keys]
    row = F.coalesce("_new", "_old")
    return old.join(new, same, "full_outer").select(*[row[c].alias(c) for c in target.columns])


def duplicate_or_null_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that ``upsert`` must not be given: those that come more than once, or hold a NULL."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter((F.col("row_count") > 1) | missing)

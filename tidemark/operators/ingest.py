"""Bronze: lineage columns, skipping of loaded files, union of sources, load summary."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.clock import as_of_column
from tidemark.schemas import BRONZE


def with_lineage(rows: DataFrame, file_name: Column | str, as_of: datetime | None) -> DataFrame:
    """All columns plus the batch label and the ingest time."""
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    return rows.withColumns({"_file_name": name, "_ingested_at": as_of_column(as_of)})


def to_bronze(rows: DataFrame) -> DataFrame:
    """The contract's columns in order; columns the source lacks are NULL, others are left out."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in BRONZE.fields
        ]
    )


def skip_ingested_files(incoming: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of ``incoming`` whose ``_file_name`` is not among those of ``loaded``, bronze or a ledger of its files.

    The names alone are compared: distinct names of the batch against those loaded, of which only the name
    column is read. The rows are then filtered by the short list of known names, whose measured size decides
    whether it is broadcast, so the rows of one large file need not meet in one task.
    """
    names = incoming.select("_file_name").distinct()
    known = names.join(loaded.select("_file_name"), "_file_name", "left_semi")
    return incoming.join(known, "_file_name", "left_anti").select(*incoming.columns)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Batches of any column order and text types under each other, matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def file_ledger(
    loaded: DataFrame, rejected: DataFrame | None = None, names: DataFrame | None = None, as_of: datetime | None = None
) -> DataFrame:
    """One row per file: how many of its rows were loaded and how many set aside, and when.

    ``names`` are files that get a row even if they hold no row at all.
    """
    parts = [loaded.select("_file_name", F.lit(1).alias("good"), F.lit(0).alias("bad"), "_ingested_at")]
    if rejected is not None:
        parts.append(rejected.select("_file_name", F.lit(0).alias("good"), F.lit(1).alias("bad"), "_ingested_at"))
    if names is not None:
        at = as_of_column(as_of).alias("_ingested_at")
        parts.append(names.select("_file_name", F.lit(0).alias("good"), F.lit(0).alias("bad"), at))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("_file_name").agg(
        F.sum("good").alias("rows_loaded"), F.sum("bad").alias("rows_rejected"), F.max("_ingested_at").alias("_ingested_at")
    )


def ingest_summary(batch: DataFrame) -> DataFrame:
    """Rows per loaded file or message batch."""
    return batch.groupBy("_file_name").agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.max("_ingested_at").alias("ingested_at")
    )

"""The contract held against what written files say of themselves."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CONTRACT

VIOLATIONS = "table_name string, column_name string, declared string, found string"
# Files of one folder disagree on a column.
SEVERAL = "several types"


def written_types(spark: SparkSession, path: str) -> dict[str, str]:
    """Column types by the footers of all Parquet files under ``path``, which Spark reads in one job; no row is read."""
    try:
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return {SEVERAL: str(error)}
    return {f.name: f.dataType.simpleString() for f in schema}


def contract_violations(
    spark: SparkSession, table: str, paths: list[str], partition: str | None = None, contract: T.StructType | None = None
) -> DataFrame:
    """``table_name, column_name, declared, found, row_count``: columns that the files under ``paths`` lack, hold as
    another type or hold beside the contract, and the number of rows under the paths with that fault.

    Types come from the files' footers, as do row counts; ``partition`` is a column kept in folder names. Faults are
    as many as columns, whatever the size of the table. No path, or nothing amiss: no rows.
    """
    declared = {f.name: f.dataType.simpleString() for f in contract or CONTRACT[table]}
    faults: dict[tuple[str | None, str | None, str | None], list[str]] = {}
    for path in paths:
        found = written_types(spark, path)
        if SEVERAL in found:
            faults.setdefault((None, None, SEVERAL), []).append(path)
            continue
        found.pop(partition, None)
        for column in {**declared, **found}:
            if column != partition and declared.get(column) != found.get(column):
                faults.setdefault((column, declared.get(column), found.get(column)), []).append(path)
    parts = [spark.createDataFrame([], f"{VIOLATIONS}, row_count long")]
    for fault, where in faults.items():
        one = spark.createDataFrame([(table, *fault)], VIOLATIONS)
        rows = spark.read.schema(T.StructType([])).parquet(*where).agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(one.withColumn("row_count", rows.scalar()))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

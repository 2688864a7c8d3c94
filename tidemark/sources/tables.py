"""Tables as folders of Parquet files, laid out in partitions by Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import delete, exists, replace_directory, subfolders


class Table:
    """One root folder, by default partitioned by one column, of which a write replaces the partitions it holds."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        schema: T.StructType,
        partition: T.StructField | None = None,
        committed: Callable[[], DataFrame] | None = None,
    ):
        """``committed`` gives the partition values that count; files of others were left by a job that died."""
        self.spark = spark
        self.path = f"{root}/{name}"
        self.staged = f"{root}/_staged/{name}"
        self.partition = partition.name if partition else None
        self.schema = T.StructType([f for f in schema if f.name != self.partition] + ([partition] if partition else []))
        self.committed = committed

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows if self.committed is None else rows.join(self.committed(), self.partition, "left_semi")

    def partition_path(self, value) -> str:
        return f"{self.path}/{self.partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"

    def write(self, rows: DataFrame, whole: bool = False) -> None:
        """Replace the partitions that ``rows`` hold, or the whole table; a repetition replaces them again. ``rows`` must
        not be read from this table."""
        self._write(rows.select(*self.schema.names), self.path, "static" if whole or not self.partition else "dynamic")

    def rewrite(self, rows: DataFrame) -> None:
        """Like ``write`` for ``rows`` that are made of this table's own: they are staged first, and ``settle`` puts
        them in place, also those of a job that died in the middle of it."""
        self._write(rows.select(*self.schema.names), self.staged, "static")
        self.settle()

    def settle(self) -> None:
        if not exists(self.spark, f"{self.staged}/_SUCCESS"):
            return
        if self.partition is None:
            replace_directory(self.spark, self.staged, self.path)
            return
        for folder in subfolders(self.spark, self.staged):
            replace_directory(self.spark, f"{self.staged}/{folder}", f"{self.path}/{folder}")
        delete(self.spark, self.staged)

    def _write(self, rows: DataFrame, path: str, overwrite: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite).option("compression", "zstd")
        (writer.partitionBy(self.partition) if self.partition else writer).parquet(path)

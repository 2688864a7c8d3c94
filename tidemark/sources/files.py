"""Directory operations of whatever file system holds a path. Names pass the driver, data does not."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, target = _resolve(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target) if status.isDirectory()]


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a UTF-8 text file, empty if it has none."""
    fs, target = _resolve(spark, path)
    java = spark._jvm.java.io
    lines = java.BufferedReader(java.InputStreamReader(fs.open(target), "UTF-8"))
    try:
        return lines.readLine() or ""
    finally:
        lines.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def move_into(spark: SparkSession, paths: list[str], directory: str) -> None:
    fs, target = _resolve(spark, directory)
    fs.mkdirs(target)
    for path in paths:
        _, source = _resolve(spark, path)
        _rename(fs, source, spark._jvm.org.apache.hadoop.fs.Path(target, source.getName()))


def replace_directory(spark: SparkSession, new: str, old: str) -> None:
    """Put ``new`` in the place of ``old``, which is kept under a hidden name until ``new`` has its place."""
    fs, source = _resolve(spark, new)
    _, target = _resolve(spark, old)
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.replaced")
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        fs.delete(aside, True)
        _rename(fs, target, aside)
    _rename(fs, source, target)
    fs.delete(aside, True)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"Could not move {source} to {target}")

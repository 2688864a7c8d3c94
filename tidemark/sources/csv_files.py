"""Event CSV files: listing, and reading by column name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import EVENT_COLUMNS
from tidemark.sources.files import first_line

# Quotes inside quoted fields are doubled; without this Spark expects a backslash.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def file_name() -> Column:
    """Base name of the file a row came from. ``_metadata.file_name`` is URL-encoded, but for '+'."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def list_csv(spark: SparkSession, directory: str) -> DataFrame:
    """``path, _file_name`` of the CSV files of a landing directory; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(directory)
        .select("path", F.substring_index("path", "/", -1).alias("_file_name"))
    )


def by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files in groups of one header line each; only the first line of each file is read."""
    groups: dict[str, list[str]] = {}
    for path in sorted(paths):
        groups.setdefault(first_line(spark, path), []).append(path)
    return list(groups.values())


def require_columns(columns: list[str], required) -> None:
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


ON_BAD_ROW = ("raise", "quarantine")
_CORRUPT = "_corrupt_row"


def read_events(
    spark: SparkSession,
    paths: str | list[str],
    required=EVENT_COLUMNS,
    multi_line: bool = False,
    on_bad_row: str = "raise",
) -> DataFrame:
    """Files, directories or globs as text columns, empty fields NULL, with ``_file_name``.

    A row with more or fewer fields than the header fails the read, or with ``on_bad_row="quarantine"`` is left
    out here and given by ``rejected_rows``.

    Columns are taken by the header's names. All files of one call have to share one header: Spark
    compares each file's header and fails on another, instead of shifting values between columns.
    Read files of another layout in a call of their own and combine with ``union_batches``.
    ``multi_line`` allows line breaks inside quotes; such files cannot be split over tasks.
    """
    if on_bad_row not in ON_BAD_ROW:
        raise ValueError(f"on_bad_row must be one of {ON_BAD_ROW}")
    names, rows = _rows(spark, paths, required, multi_line, on_bad_row)
    wanted = [c for c in names if c in EVENT_COLUMNS]
    if on_bad_row == "quarantine":
        rows = rows.filter(_misfit(names).isNull())
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in wanted], file_name().alias("_file_name"))


def rejected_rows(
    spark: SparkSession, paths: str | list[str], required=EVENT_COLUMNS, multi_line: bool = False
) -> DataFrame:
    """``value, _file_name`` of the rows that ``read_events`` leaves out, as they stand in the file."""
    names, rows = _rows(spark, paths, required, multi_line, "quarantine")
    return rows.filter(_misfit(names).isNotNull()).select(F.col(_CORRUPT).alias("value"), file_name().alias("_file_name"))


def file_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value, _file_name`` of every line of files that can't be read as events."""
    return spark.read.text(paths).select("value", file_name().alias("_file_name"))


def _misfit(names: list[str]) -> Column:
    """The raw text of a row that does not fit, else NULL. Spark refuses to read that column alone, so the first
    column is named as well, in a term that is always NULL."""
    first = F.col(names[0])
    return F.coalesce(F.col(_CORRUPT), F.nullif(first, first))


def _rows(spark: SparkSession, paths, required, multi_line: bool, on_bad_row: str) -> tuple[list[str], DataFrame]:
    """The header's names, and all rows as text with the raw text of those that do not fit the header."""
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    try:
        names = reader.csv(paths).columns
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"No input CSV files found for {paths!r}") from error
    require_columns(names, required)
    corrupt = [_CORRUPT] if on_bad_row == "quarantine" else []
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, *corrupt]])
    mode = "PERMISSIVE" if corrupt else "FAILFAST"
    reader = reader.option("mode", mode).option("columnNameOfCorruptRecord", _CORRUPT)
    # With pruned columns Spark would not see that a row is too long or too short.
    return names, reader.option("columnPruning", False).schema(text).option("enforceSchema", False).csv(paths)

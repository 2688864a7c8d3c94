"""System time. Every timestamp the pipeline stamps comes from one injected ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def utc(as_of: datetime) -> datetime:
    """A naive datetime is taken as UTC."""
    return as_of.replace(tzinfo=timezone.utc) if as_of.tzinfo is None else as_of.astimezone(timezone.utc)


def as_of_column(as_of: datetime | None) -> Column:
    """``as_of`` as a TIMESTAMP literal that no time zone setting can shift; None is the query's own clock."""
    if as_of is None:
        return F.current_timestamp()
    return F.timestamp_micros(F.lit((utc(as_of) - EPOCH) // timedelta(microseconds=1)))


def label(as_of: datetime) -> str:
    """Sortable directory label of a build or ingest time."""
    return utc(as_of).strftime("%Y%m%dT%H%M%S%f")


def use_utc(spark: SparkSession) -> None:
    """Event times are UTC wall clock, so the session zone has to be UTC as well."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

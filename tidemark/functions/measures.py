"""Ratios, rounding and number formatting, all in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round the scaled binary value, as C's round() does: 1.005 at 2 digits is 1.0.

    Spark's own round(double, 2) rounds the shortest decimal text instead and gives 1.01.
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 * part / whole, NULL when whole is 0."""
    ratio = F.lit(100.0) * part / F.nullif(whole, F.lit(0).cast("bigint"))
    return ratio if digits is None else round_half_away(ratio, digits)


def plain_decimal(value: Column) -> Column:
    """At most four decimals, at least one, never an exponent: '100.0', '0.0001', '10000000.0'."""
    text = F.regexp_replace(F.format_string("%.4f", value), r"(\.\d+?)0+$", "$1")
    return F.when(value.isNotNull(), text)

"""Text normalisation of brands, categories and event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: bucket of missing brands and categories.
UNKNOWN = "__UNKNOWN__"

# The characters with the Unicode White_Space property.
WHITESPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            0x20,
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)


def known_or_unknown(text: Column) -> Column:
    """Trimmed text; NULL and blank fall into the unknown bucket."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(UNKNOWN))


def strip_whitespace(text: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    trimmed = F.trim(text)
    # Trimming by a character list is slow. It is not needed between two printable ASCII characters.
    clean = F.ascii(trimmed).between(0x21, 0x7E) & F.ascii(F.right(trimmed, F.lit(1))).between(0x21, 0x7E)
    return F.when(clean, trimmed).otherwise(F.trim(text, F.lit(WHITESPACE)))


def plain_time(text: Column) -> Column:
    """The first 19 characters of times in the usual form, '2019-10-01 00:00:00' with or without ' UTC'; else NULL."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d( UTC)?$"), F.substring(text, 1, 19))


def strip_utc(text: Column) -> Column:
    """Event time text without its UTC suffix."""
    return F.regexp_replace(text, r"\s+UTC\s*$", "")


def category_level(code: Column, level: int) -> Column:
    """Level n of a dot-separated category; absent level is '', NULL code is NULL."""
    return F.split_part(code, F.lit("."), F.lit(level))

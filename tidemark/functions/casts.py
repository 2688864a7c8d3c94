"""Tolerant casts of event text. Whatever cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A complete date, with dashes or slashes, opens the text. Spark would also read '2019', '2019-10' and '+2019-10'.
_DATE = r"^\s*\d{4}([-/])\d{1,2}\1\d{1,2}(?!\d)"
_SLASHES = r"^(\s*\d{4})/(\d{1,2})/"


def to_double(text: Column) -> Column:
    """DOUBLE or NULL. Java's type suffixes ('1.5d', '2f') are not numbers in event text."""
    tail = F.lower(F.rtrim(text))
    java_suffix = (tail.endswith("d") | tail.endswith("f")) & ~tail.endswith("inf")
    return F.when(~java_suffix, text.try_cast("double"))


def to_int(text: Column) -> Column:
    """INTEGER or NULL; decimal and exponent forms round half away from zero, overflow is NULL."""
    return F.coalesce(text.try_cast("int"), F.round(to_double(text)).try_cast("int"))


def to_event_time(text: Column) -> Column:
    """TIMESTAMP_NTZ or NULL; dates with dashes or slashes, a zone suffix such as ' UTC' is read and dropped."""
    dashed = F.when(text.contains("/"), F.regexp_replace(text, _SLASHES, "$1-$2-")).otherwise(text)
    return F.when(text.rlike(_DATE), dashed.try_cast("timestamp_ntz"))

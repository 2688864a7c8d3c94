"""The surrogate key of an event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.casts import to_event_time
from tidemark.functions.text import plain_time, strip_utc


def _number_text(text: Column) -> Column:
    """Whole numbers in their plain form ('007' -> '7'), other text as it is."""
    return F.coalesce(text.try_cast("bigint").cast("string"), text)


def _time_text(text: Column) -> Column:
    """Times in one form whatever the source wrote ('T', ' UTC', '.500'), other text without its suffix."""
    return F.coalesce(plain_time(text), to_event_time(text).cast("string"), strip_utc(text))


def event_id(
    event_time: Column, event_type: Column, user_id: Column, product_id: Column, user_session: Column
) -> Column:
    """MD5 over the five identifying fields, without delimiter; NULL as soon as one of them is NULL.

    Fields are brought into one text form first, so that the same event from a CSV file and from the
    message stream gets the same id. ``concat`` is needed here: ``concat_ws`` would skip NULLs.
    """
    return F.md5(
        F.concat(
            _time_text(event_time), event_type, _number_text(user_id), _number_text(product_id), user_session
        )
    )

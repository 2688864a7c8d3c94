from tidemark.functions.casts import to_double, to_event_time, to_int
from tidemark.functions.ids import event_id
from tidemark.functions.measures import percent, plain_decimal, round_half_away
from tidemark.functions.text import UNKNOWN, category_level, known_or_unknown, plain_time, strip_utc, strip_whitespace

__all__ = [
    "UNKNOWN",
    "category_level",
    "event_id",
    "known_or_unknown",
    "percent",
    "plain_decimal",
    "plain_time",
    "round_half_away",
    "strip_utc",
    "strip_whitespace",
    "to_double",
    "to_event_time",
    "to_int",
]

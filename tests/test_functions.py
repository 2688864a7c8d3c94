from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    category_level,
    event_id,
    known_or_unknown,
    percent,
    plain_decimal,
    round_half_away,
    strip_utc,
    strip_whitespace,
    to_double,
    to_event_time,
    to_int,
)


def apply(spark, function, values, kind="string"):
    """``function`` over one column; results in the order of the values."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_to_int(spark):
    texts = ["12", " 12 ", "1.5", "2.5", "-2.5", "1e2", "3000000000", "", "abc", "1d", None, "nan"]
    assert apply(spark, to_int, texts) == [12, 12, 2, 3, -3, 100, None, None, None, None, None, None]


def test_to_double(spark):
    texts = ["1.5", " 2 ", "1e2", ".5", "1d", "2F", "-inf", "n/a", "", None]
    assert apply(spark, to_double, texts) == [1.5, 2.0, 100.0, 0.5, None, None, float("-inf"), None, None, None]


def test_to_event_time(spark):
    texts = ["2019-10-01 00:00:00 UTC", "2019-10-01T01:02:03", "2019-10-01", "2019", "2019-10", "12:30:00", "x", None]
    day = datetime(2019, 10, 1)
    expected = [day, datetime(2019, 10, 1, 1, 2, 3), day, None, None, None, None, None]
    assert apply(spark, to_event_time, texts) == expected


def test_strip(spark):
    assert apply(spark, strip_utc, ["a  UTC ", "UTC", "a UTC b", None]) == ["a", "UTC", "a UTC b", None]
    texts = ["  a b ", "\t\na ", " é　", "é", " ", "", None]
    assert apply(spark, strip_whitespace, texts) == ["a b", "a", "é", "é", "", "", None]


def test_known_or_unknown(spark):
    texts = [None, "", "  ", " a ", "\ta"]
    assert apply(spark, known_or_unknown, texts) == ["__UNKNOWN__", "__UNKNOWN__", "__UNKNOWN__", "a", "\ta"]


def test_category_levels(spark):
    codes = ["a.b.c.d", "a", "", None]
    assert apply(spark, lambda c: category_level(c, 1), codes) == ["a", "a", "", None]
    assert apply(spark, lambda c: category_level(c, 3), codes) == ["c", "", "", None]


def test_rounding_follows_the_binary_value(spark):
    assert apply(spark, lambda c: round_half_away(c, 2), [1.005, 2.675, 0.125, -0.125, None], "double") == [
        1.0,
        2.68,
        0.13,
        -0.13,
        None,
    ]


def test_plain_decimal(spark):
    values = [100.0, 99.9798, 0.0001, 1e7, 12.5, 0.0, None]
    texts = ["100.0", "99.9798", "0.0001", "10000000.0", "12.5", "0.0", None]
    assert apply(spark, plain_decimal, values, "double") == texts


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(percent(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), 2)).first()[0] is None


@pytest.mark.parametrize(
    ("time", "user", "product", "hashed"),
    [
        ("2019-10-01 00:00:00 UTC", "7", "1", "2019-10-01 00:00:00view71s"),
        ("2019-10-01 00:00:00", "007", " 1", "2019-10-01 00:00:00view71s"),
        ("2019-10-01T00:00:00", "7", "1", "2019-10-01 00:00:00view71s"),
        ("2019-10-01 00:00:00.500 UTC", "7", "1", "2019-10-01 00:00:00.5view71s"),
        ("not-a-time UTC", "7", "1.5", "not-a-timeview71.5s"),
        ("2019-13-45 00:00:00 UTC", "x", "1", "2019-13-45 00:00:00viewx1s"),
    ],
)
def test_event_id_text(spark, time, user, product, hashed):
    """One id for one event, however the source wrote its time and numbers."""
    columns = [F.lit(v) for v in (time, "view", user, product, "s")]
    expected = hashlib.md5(hashed.encode()).hexdigest()
    assert spark.range(1).select(event_id(*columns)).first()[0] == expected


@pytest.mark.parametrize("missing", range(5))
def test_event_id_is_null_without_any_part(spark, missing):
    parts = ["2019-10-01 00:00:00", "view", "7", "1", "s"]
    parts[missing] = None
    assert spark.range(1).select(event_id(*[F.lit(p).cast("string") for p in parts])).first()[0] is None


def test_event_id_has_no_delimiter(spark):
    """User 1 with product 23 collides with user 12 and product 3."""
    first = event_id(*[F.lit(v) for v in ("2019-10-01 00:00:00", "view", "1", "23", "s")])
    second = event_id(*[F.lit(v) for v in ("2019-10-01 00:00:00", "view", "12", "3", "s")])
    assert spark.range(1).select(first == second).first()[0]

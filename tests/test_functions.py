from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions import (
    auto_timestamp,
    blank_as_null,
    coerce_date,
    coerce_number,
    coerce_timestamp,
    duration_seconds,
    empty_as_null,
    initcap_words,
    number_from_text,
    snake_name,
    surrogate_key,
    truncate_bytes,
    truncate_to,
)

QUIET = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.x for r in df.select("i", fn("c").alias("x")).orderBy("i").collect()]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    got = [r[0] for r in df.select(surrogate_key("k", "n")).collect()]
    want = ["a-1", "_dbt_utils_surrogate_key_null_-2"]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in want]


def test_initcap_words(spark):
    got = apply(spark, ["mary-ann o'neil", "élan VITAL", "", None, "x2y z"], initcap_words)
    assert got == ["Mary-Ann O'Neil", "Élan Vital", "", None, "X2y Z"]


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("PT1H1M30S", 3690),
        ("P1DT2H", 93600),
        ("PT30.9S", 30),
        ("-PT5M", -300),
        ("12", 12),
        ("12.7", 12),
        ("-3", -3),
        (" 60 ", 60),
        ("PT", None),
        ("P", None),
        ("garbage", None),
        ("99999999999", None),
        ("PT99999999999999999999H", None),
        (None, None),
    ],
)
def test_duration_seconds(spark, text, seconds):
    assert apply(spark, [text], duration_seconds) == [seconds]


def test_dates_in_all_layouts(spark):
    day = dt.date(2026, 1, 31)
    texts = ["2026-01-31", "01/31/2026", "31-Jan-2026", "20260131", "2026-01-31T09:30:00"]
    assert apply(spark, texts, coerce_date) == [day] * 5
    bad = ["2026-02-31", "2026", "31/01/2026", "2026-01-31 25:00:00", "", None, "tomorrow"]
    assert apply(spark, bad, coerce_date) == [None] * 7


def test_timestamps_in_all_layouts(spark):
    at = dt.datetime(2026, 1, 31, 10, 0)
    texts = [
        "2026-01-31T10:00:00",
        "2026-01-31 10:00:00",
        "01/31/2026 10:00:00",
        "31-Jan-2026 10:00",
        "20260131100000",
        "2026-01-31T12:00:00+02:00",
    ]
    assert apply(spark, texts, coerce_timestamp) == [at] * 6
    assert apply(spark, ["2026-01-31"], coerce_timestamp) == [dt.datetime(2026, 1, 31)]
    assert apply(spark, ["31.01.2026", "Jan-31-2026", "2026/01/31"], auto_timestamp) == [
        dt.datetime(2026, 1, 31)
    ] * 3


@QUIET
@given(st.lists(st.datetimes(dt.datetime(1950, 1, 1), dt.datetime(2100, 1, 1)), min_size=1, max_size=8))
def test_timestamp_layouts_round_trip(spark, stamps):
    stamps = [s.replace(microsecond=0) for s in stamps]
    for layout in ("%m/%d/%Y %H:%M:%S", "%Y%m%d%H%M%S", "%Y-%m-%dT%H:%M:%S"):
        assert apply(spark, [s.strftime(layout) for s in stamps], coerce_timestamp) == stamps
    minutes = [s.replace(second=0) for s in stamps]
    assert apply(spark, [s.strftime("%d-%b-%Y %H:%M") for s in stamps], coerce_timestamp) == minutes


def test_numbers(spark):
    got = apply(spark, ["12.5", " 7 ", "1e3", "NaN", "Infinity", "x", "", None], number_from_text)
    assert got == [12.5, 7.0, 1000.0, None, None, None, None, None]
    df = spark.sql("""SELECT parse_json(c) v FROM VALUES
        ('{"a": 12.5}'), ('{"a": "12.5"}'), ('{"a": null}'), ('{}'), ('{"a": [1]}') t(c)""")
    got = [r[0] for r in df.select(coerce_number("v", "$.a")).collect()]
    assert got == [12.5, 12.5, None, None, None]
    ints = [r[0] for r in df.select(coerce_number("v", "$.a", "int")).collect()]
    assert ints == [None] * 5


def test_truncation(spark):
    assert apply(spark, ["abcdef", "ab", None], lambda c: truncate_to(c, 4)) == ["abcd", "ab", None]
    texts = ["héé", "日本", "abcdef", "😀😀", "", None]
    got = apply(spark, texts, lambda c: truncate_bytes(c, 4))
    assert got == ["hé", "日", "abcd", "😀", "", None]


@QUIET
@given(st.lists(st.text(max_size=12), min_size=1, max_size=8), st.integers(1, 9))
def test_truncate_bytes_is_the_longest_whole_prefix(spark, texts, n):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]

    def cut(t):
        return t.encode()[:n].decode("utf-8", "ignore")

    assert apply(spark, texts, lambda c: truncate_bytes(c, n)) == [cut(t) for t in texts]


def test_blank_and_empty(spark):
    assert apply(spark, ["  ", "\t", "", "a ", None], blank_as_null) == [None, None, "", "a ", None]
    assert apply(spark, ["  ", "", "a", None], empty_as_null) == ["  ", None, "a", None]


def test_snake_name():
    names = ["TagID", "GPSCoordinates", "UnitOfMeasure", "LastUpdated", "value"]
    want = ["tag_id", "gps_coordinates", "unit_of_measure", "last_updated", "value"]
    assert [snake_name(n) for n in names] == want

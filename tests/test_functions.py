"""Column functions on hand-made values."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradin.functions import calendar, keys, scores, text, typing


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def either_mode(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(function(F.col("v"))).collect()]


def test_trim_strips_blanks_only(spark):
    assert apply(spark, ["  a b ", "\ta ", " a", None], text.trimmed) == [
        "a b", "\ta", " a", None,
    ]
    assert apply(spark, ["\t a "], lambda c: text.trimmed(c, " \t ")) == ["a"]


def test_null_tokens_in_any_case(spark):
    values = [" NaN ", "none", "NULL", "", "   ", "nano", "\tnull", None]
    assert apply(spark, values, text.clean_text) == [None] * 5 + ["nano", "\tnull", None]
    assert apply(spark, ["null", "-"], lambda c: text.clean_text(c, ("-",))) == ["null", None]


def test_first_filled_takes_the_last_as_it_is(spark):
    df = spark.createDataFrame(
        [("", "b", "1"), (None, "", ""), ("a", "b", "1"), (None, None, None)], "a string, b string, c string"
    )
    found = df.select(text.first_filled(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in found] == ["b", "", "a", None]


def test_integers(spark, either_mode):
    cases = {
        "12": 12, "-3": -3, "+4": 4, "2.0": 2, "2.9": 2, "-2.9": -2, ".5": 0, "5.": 5,
        "\t7 ": 7, "abc": None, "": None, "1e3": None, "1.2.3": None, "-3.x": None, "+": None,
        "99999999999": None, "2147483647": 2147483647, "2147483648": None, "٣": None,
    }
    assert dict(zip(cases, apply(spark, cases, typing.to_int))) == cases
    assert apply(spark, ["99999999999", "9223372036854775808", None], typing.to_long) == [
        99999999999, None, None,
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-.eE \t\x1cx", max_size=12), min_size=50, max_size=200))
def test_integers_equal_a_lenient_cast(spark, values):
    found = [apply(spark, values, f) for f in (typing.to_int, typing.to_long)]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        expected = [apply(spark, values, lambda c, k=k: c.cast(k)) for k in ("int", "bigint")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert found == expected


def test_dates_and_times(spark, either_mode):
    dates = ["1987-06-24", "1987", "2026-6-1", "2026-02-30", "x", None]
    assert apply(spark, dates, typing.to_date) == [dt.date(1987, 6, 24)] + [None] * 5
    times = ["2026-06-11 19:00:05", "2026-06-11 19:00", "TBD", None]
    assert apply(spark, times, lambda c: typing.to_timestamp(c).cast("string")) == [
        "2026-06-11 19:00:05", None, None, None,
    ]
    minutes = ["2026-06-11 19:00", "2026-06-11 19:00:05", "2026-06-11"]
    assert apply(
        spark, minutes, lambda c: typing.day_of(typing.to_timestamp(c, typing.MINUTE_FORMAT))
    ) == [dt.date(2026, 6, 11), None, None]


def test_numeric_rounds_half_up_and_overflows_to_null(spark, either_mode):
    found = apply(spark, [1.005, 2.345, 999.994, 999.995, 1000.0, None], typing.to_numeric, "double")
    assert [None if v is None else str(v) for v in found] == [
        "1.01", "2.35", "999.99", None, None, None,
    ]


PAIRS = [(2, 1), (1, 2), (1, 1), (None, 1), (1, None), (None, None)]


def pairs(spark, *columns):
    df = spark.createDataFrame(PAIRS, "h int, a int")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_outcome_with_and_without_scores(spark):
    h, a = F.col("h"), F.col("a")
    found = pairs(spark, scores.outcome(h, a), scores.outcome(h, a, unknown=None))
    assert [r[0] for r in found] == ["HOME_WIN", "AWAY_WIN", "DRAW", "DRAW", "DRAW", "DRAW"]
    assert [r[1] for r in found] == ["HOME_WIN", "AWAY_WIN", "DRAW", None, None, None]


def test_winner_and_total(spark, either_mode):
    h, a = F.col("h"), F.col("a")
    found = pairs(spark, scores.winner(h, a, F.lit(10), F.lit(20)), scores.total(h, a))
    assert found == [(10, 3), (20, 3), (None, 2), (None, None), (None, None), (None, None)]
    top = spark.range(1).select(scores.total(F.lit(2147483647), F.lit(1))).first()
    assert top[0] is None


def test_ratio(spark):
    df = spark.createDataFrame([(1, 8), (7, 3), (5, 0), (0, 4), (2, -1), (3, None)], "a int, b int")
    found = df.select(scores.safe_ratio(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in found] == [0.13, 2.33, 0.0, 0.0, 0.0, 0.0]


def test_played_statuses(spark):
    values = ["FINISHED", " in_play ", "PAUSED", "SUSPENDED", "AWARDED", "TIMED", "", None]
    assert apply(spark, values, scores.is_played) == [True] * 5 + [False] * 3


def test_groups(spark):
    values = ["GROUP_A", "group l", "GROUP_M", "Last 16", "GROUP_AB", ""]
    assert apply(spark, values, scores.group_label) == [
        "Groupe A", "Groupe L", "GROUP_M", "Last 16", "GROUP_AB", "",
    ]
    assert apply(spark, values, scores.group_slug) == [
        "groupe_a", "groupe_l", "group_m", "last_16", "group_ab", "",
    ]
    df = spark.createDataFrame(
        [("A", "S"), ("", "S"), (None, None), (None, "")], "g string, s string"
    )
    found = df.select(scores.group_or_stage(F.col("g"), F.col("s"))).collect()
    assert [r[0] for r in found] == ["A", "S", "INCONNU", ""]


def test_hash_key(spark, either_mode):
    df = spark.createDataFrame(
        [("", "World"), (None, "World"), (None, None), ("", "")], "stade string, ville string"
    )
    found = df.select(
        keys.hash_key(F.col("stade"), F.col("ville")),
        keys.venue_key(F.col("stade"), F.col("ville")),
        keys.hash_key(F.col("stade"), F.col("ville"), bits=64) >= 0,
    ).collect()
    assert [tuple(r) for r in found] == [
        (234213619, 234213619, True),
        (234213619, 234213619, True),
        (1176845985, None, True),
        (1176845985, 1176845985, True),
    ]


def test_calendar(spark):
    days = [dt.date(2026, 6, 11), dt.date(2027, 1, 1), dt.date(2026, 6, 14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    parts = calendar.calendar_parts(F.col("d"))
    found = df.select(calendar.date_key(F.col("d")), *parts.values()).collect()
    assert [tuple(r) for r in found] == [
        (20260611, 11, 6, "June", 2026, 5, "Thursday", 24),
        (20270101, 1, 1, "January", 2027, 6, "Friday", 53),
        (20260614, 14, 6, "June", 2026, 1, "Sunday", 24),
    ]


def test_iso_to_minute(spark, either_mode):
    cases = {
        "2026-06-11T19:00:00Z": "2026-06-11 19:00",
        "2026-06-11T23:30:00+02:00": "2026-06-11 23:30",
        "2026-06-11 19:00:00.123456": "2026-06-11 19:00",
        "2026-06-11T19:00": "2026-06-11 19:00",
        "2026-06-11": "2026-06-11 00:00",
        "2026-06-11T19:00:99Z": "2026-06-11T19:00:99Z",
        "2026-13-11T19:00:00Z": "2026-13-11T19:00:00Z",
        "TBD": "TBD",
        "": "",
    }
    assert dict(zip(cases, apply(spark, cases, calendar.iso_to_minute))) == cases

"""Scalar functions: code maps, weekday, timestamp text forms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from trip_star.functions import (
    payment_type_name,
    rate_code_name,
    store_and_fwd_bool,
    timestamp_text,
    vendor_name,
    weekday,
)
from trip_star.plans import dimension


def test_unknown_code_gives_null_and_keeps_the_row(spark):
    df = spark.createDataFrame([(0, 1), (1, 99), (2, None)], "row_pos long, RatecodeID int")
    out = {r["RatecodeID"]: r["rate_code_name"] for r in dimension(df, "rate_codes").collect()}
    assert out == {1: "Standard rate", 99: None, None: None}


def test_code_maps(spark):
    df = spark.createDataFrame([(1, "Y"), (2, "N"), (6, "?")], "code int, flag string")
    got = df.select(
        payment_type_name("code").alias("p"),
        vendor_name("code").alias("v"),
        rate_code_name("code").alias("r"),
        store_and_fwd_bool("flag").alias("b"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Credit Card", "Creative Mobile Technologies", "Standard rate", True),
        ("Cash", "VeriFone Inc", "JFK", False),
        ("Voided trip", None, "Group ride", None),
    ]


def test_weekday_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 3, 1),), (dt.datetime(2016, 3, 6),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(weekday("t")).collect()] == [1, 6]


def test_midnight_only_text_keeps_the_time(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 3, 1),), (dt.datetime(2016, 3, 2),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(timestamp_text("t")).collect()] == [
        "2016-03-01 00:00:00",
        "2016-03-02 00:00:00",
    ]


def test_text_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 3, 13, 2, 30),)], "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(timestamp_text("t"), F.hour("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == ("2016-03-13 02:30:00", 2)

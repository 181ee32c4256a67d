"""Nulls, blanks, midnight, daylight saving and rounding of the scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skein.functions import scalars as S


def values(df, c="x"):
    return [r[c] for r in df.select(c).collect()]


def test_clock(spark):
    df = spark.createDataFrame([("2400",), ("0005",), ("1530",), ("",), (None,), ("ab12",)], "t string")
    df = df.select(S.clock_text("t").alias("t")).withColumn("x", S.clock_minutes("t"))
    assert values(df, "t") == ["2359", "0005", "1530", "", None, "ab12"]
    assert values(df) == [1439, 5, 930, None, None, None]


def test_rounding_keeps_nulls(spark):
    df = spark.createDataFrame([(2.7,), (-2.7,), (2.5,), (None,)], "v double").select(S.whole("v").alias("x"))
    assert values(df) == [3, -3, 3, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-50,), (500,), (7,), (None,)], "v int").select(S.clip("v", -30, 300).alias("x"))
    assert values(df) == [-30, 300, 7, None]


def test_daylight_saving(spark):
    df = spark.createDataFrame([("2024-01-15", 600), ("2024-03-10", 150), ("2024-07-01", 600)], "d string, m int")
    df = df.select(S.to_utc(S.local_timestamp(F.col("d").cast("date"), "m"), F.lit("America/New_York")).alias("x"))
    assert values(df) == [dt.datetime(2024, 1, 15, 15), dt.datetime(2024, 3, 10, 7, 30), dt.datetime(2024, 7, 1, 14)]


def test_unknown_zone_gives_null(spark):
    df = spark.range(1).select(S.to_utc(F.lit("2024-01-01").cast("timestamp_ntz"), F.lit(None).cast("string")).alias("x"))
    assert values(df) == [None]


def test_arrival_day(spark):
    rows = [("2024-01-31", 1380, 180, 120), ("2024-01-31", 600, 120, 720), ("2024-01-31", 600, None, 720)]
    df = spark.createDataFrame(rows, "d string, dep int, e int, a int").select(S.arrival_day(F.col("d").cast("date"), "dep", "e", "a").alias("x"))
    assert values(df) == [dt.date(2024, 2, 1), dt.date(2024, 1, 31), dt.date(2024, 1, 31)]


def test_week_starts_on_sunday(spark):
    df = spark.createDataFrame([("2024-01-06",), ("2024-01-07",), ("2024-01-08",)], "d string").select(S.week_start(F.col("d").cast("date")).alias("x"))
    assert values(df) == [dt.date(2023, 12, 31), dt.date(2024, 1, 7), dt.date(2024, 1, 7)]


def test_keys_and_routes(spark):
    df = spark.createDataFrame([("a", None, "c"), ("a", "b", "c")], "x string, y string, z string")
    assert values(df.select(S.route("x", "y").alias("r")), "r") == [None, "a-b"]
    assert len(set(values(df.select(S.surrogate_key("x", "y", "z").alias("k")), "k"))) == 2

"""Column expressions on hand-made boundary rows."""

import datetime as dt

from pyspark.sql import functions as F

from txrisk.functions import bins, calendar
from txrisk.functions.fixedpoint import decode, encode
from txrisk.functions.numeric import amount_log, amount_rounded


def test_fixed_point_rounding(spark):
    # fx_rounding: rounding acts on the double product (HALF_UP)
    df = spark.createDataFrame([(0.005,), (0.015,), (-0.005,), (0.285,), (1.005,), (None,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(encode(F.col("x"))).collect()]
    assert got == [1, 2, -1, 28, 100, None, None]


def test_fixed_point_strings_and_decode(spark):
    # fx_strings: numeric strings are parsed as double, not cast to bigint
    df = spark.createDataFrame([("32266.83",)], "x string")
    enc = df.select(encode(F.col("x")).alias("e"))
    assert enc.first()[0] == 3226683
    assert enc.select(decode(F.col("e"))).first()[0] == 32266.83


def test_amount_and_risk_bounds(spark):
    df = spark.createDataFrame([(99.99, 0.25), (100.0, 0.5), (500.0, 0.75), (2000.0, 0.2499), (None, None)],
                               "amount double, risk double")
    rows = df.select(bins.amount_category(F.col("amount")), bins.risk_category(F.col("risk"))).collect()
    assert [tuple(r) for r in rows] == [
        ("Small", "Low Risk"), ("Medium", "Medium Risk"), ("Large", "High Risk"),
        ("Very Large", "Very Low Risk"), ("Very Large", "Very Low Risk")]


def test_hour_bins(spark):
    hours = [4, 5, 6, 11, 12, 17, 18, 22, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    rows = df.select(bins.hour_category(F.col("h")), bins.time_bucket(F.col("h"))).collect()
    cats = [r[0] for r in rows]
    assert cats == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening",
                    "Night", "Night"]
    buckets = [r[1] for r in rows]
    assert buckets[0].startswith("Midnight") and buckets[1].startswith("Early Morning")
    assert buckets[3].startswith("Morning") and buckets[4].startswith("Midday")
    assert buckets[5].startswith("Afternoon") and buckets[6].startswith("Evening")
    assert buckets[8].startswith("Night") and buckets[9] == "Unknown"


def test_month_category_bounds(spark):
    df = spark.createDataFrame([(d,) for d in [1, 10, 11, 20, 21, 31]], "d int")
    got = [r[0] for r in df.select(bins.month_category(F.col("d"))).collect()]
    assert [g.split(" (")[0] for g in got] == ["Beginning", "Beginning", "Mid Month", "Mid Month",
                                               "Month End", "Month End"]


def test_calendar_names_and_flags(spark):
    # fx_calendar: one row per weekday, 2024-01-01 is a Monday
    days = [dt.datetime(2024, 1, 1 + i, 10, 30) for i in range(7)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    ts = F.col("ts")
    rows = df.select(calendar.day_name(ts), F.weekday(ts), calendar.is_weekend(ts), bins.day_classification(ts),
                     calendar.month_name(ts), calendar.is_peak_hour(ts)).collect()
    assert [r[0] for r in rows] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert [r[1] for r in rows] == list(range(7))
    assert [r[2] for r in rows] == [False] * 5 + [True] * 2
    assert [r[3] for r in rows] == ["Weekday"] * 5 + ["Weekend"] * 2
    assert {r[4] for r in rows} == {"January"}
    assert all(r[5] for r in rows)  # 10:30 is a peak hour


def test_season(spark):
    months = ["January", "March", "April", "October", "November", "December", "Foo"]
    df = spark.createDataFrame([(m,) for m in months], "m string")
    got = [r[0] for r in df.select(bins.season(F.col("m"))).collect()]
    assert got == ["Dry Season", "Dry Season", "Rainy Season", "Rainy Season", "Dry Season", "Dry Season", "Unknown"]


def test_parse_timestamp_strict(spark):
    df = spark.createDataFrame([("2023-01-14 04:31:09",)], "s string")
    got = df.select(calendar.parse_timestamp(F.col("s"), df.schema["s"].dataType)).first()[0]
    assert got == dt.datetime(2023, 1, 14, 4, 31, 9)


def test_worked_example(spark):
    # fx_worked: amount 32266.83 -> log 10.38; ratio to mean 170389.87 -> 0.189
    df = spark.createDataFrame([(32266.83, 170389.87), (5000.0, 1.0)], "a double, m double")
    rows = df.select(amount_log(F.col("a")), (F.col("a") / F.col("m")), amount_rounded(F.col("a"))).collect()
    assert round(rows[0][0], 2) == 10.38
    assert round(rows[0][1], 3) == 0.189
    assert [rows[0][2], rows[1][2]] == [0, 1]


def test_is_fraudulent(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,)], "y double")
    assert [r[0] for r in df.select(bins.is_fraudulent(F.col("y"))).collect()] == [True, False, False]

"""Scalar functions against golden values (FIXTURES.md A1 and C)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wxspark.functions import expr as X


def one(spark, col, schema="x double", rows=((None,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(col.alias("o")).collect()]


@pytest.mark.parametrize("value,digits,expected", [(0.125, 2, 0.12), (2.675, 2, 2.68), (1.005, 2, 1.0), (0.5, 0, 0.0), (1.5, 0, 2.0)])
def test_round_half_even_matches_numpy(spark, value, digits, expected):
    import numpy as np

    got = one(spark, X.round_half_even("x", digits), rows=[(value,)])[0]
    assert got == expected == float(np.round(value, digits))


def test_heat_index_golden(spark):
    rows = [(34.2, 78), (-5.0, 40)]
    got = [r[0] for r in spark.createDataFrame(rows, "t double, h int").select(X.heat_index("t", "h")).collect()]
    assert got == [51.9, 75.6]
    guarded = spark.createDataFrame(rows, "t double, h int").select(X.heat_index("t", "h", guarded=True)).collect()
    assert [r[0] for r in guarded] == [51.9, None]


@pytest.mark.parametrize(
    "profile,temps,expected",
    [
        ("batch", [9.99, 10, 18, 20, 26, 28, 33, 35, None], ["Cold", "Cool", "Cool", "Comfortable", "Comfortable", "Warm", "Warm", "Hot", "Unknown"]),
        ("live", [9.99, 10, 18, 20, 26, 28, 33, 35, None], ["Cold", "Cool", "Comfortable", "Comfortable", "Warm", "Warm", "Hot", "Hot", None]),
    ],
)
def test_comfort_edges(spark, profile, temps, expected):
    got = one(spark, X.comfort_level("x", profile), rows=[(None if t is None else float(t),) for t in temps])
    assert got == expected


def test_title_case_like_python(spark):
    texts = ["light-intensity o'clock 3rd RAIN", "overcast clouds", "", "x", "ÉTÉ chaud-froid", "scattered  clouds"]
    got = one(spark, X.title_case("x"), schema="x string", rows=[(t,) for t in texts])
    assert got == [t.title() for t in texts]
    assert got[0] == "Light-Intensity O'Clock 3Rd Rain"


def test_strip_whitespace(spark):
    assert one(spark, X.strip_whitespace("x"), schema="x string", rows=[(" \tKolkata \n",)]) == ["Kolkata"]


def test_epoch_and_iso(spark):
    df = spark.createDataFrame([("1694784000", "2024-09-15T14:30:00.123456"), ("0", ""), (None, None), ("abc", "x")], "dt string, iso string")
    got = df.select(X.epoch_to_timestamp("dt"), X.iso_truncate("iso")).collect()
    assert got[0][0] == datetime(2023, 9, 15, 13, 20) and got[0][1] == datetime(2024, 9, 15, 14, 30)
    assert got[1][0] is None and got[1][1] is None
    assert got[2][0] is None and got[3][0] is None and got[3][1] is None


@pytest.mark.parametrize("hour,band", [(4, "night"), (5, "dawn"), (6, "dawn"), (7, "day"), (16, "day"), (17, "dusk"), (19, "dusk"), (20, "night")])
def test_time_of_day_edges(spark, hour, band):
    df = spark.createDataFrame([(datetime(2024, 1, 1, hour, 30),)], "t timestamp_ntz")
    assert df.select(X.time_of_day("t")).first()[0] == band


def test_local_clock_label(spark):
    df = spark.createDataFrame([(1694784000, 19800), (1694736000, 0), (1694779200, 0)], "u long, off long")
    assert [r[0] for r in df.select(X.local_clock_label("u", "off")).collect()] == ["6:50 PM", "12:00 AM", "12:00 PM"]


def test_local_time_shift(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 22, 0), 19800)], "t timestamp_ntz, off int")
    assert df.select(X.local_time("t", "off")).first()[0] == datetime(2024, 1, 2, 3, 30)


def test_icons(spark):
    rows = [("Clear", "night"), ("Clear", "dawn"), ("Clear", "day"), ("Clouds", "day"), ("Volcano", "day"), ("Haze", "night")]
    df = spark.createDataFrame(rows, "c string, tod string")
    got = [r[0] for r in df.select(X.condition_icon("c", "tod")).collect()]
    assert got == ["🌙", "🌄", "☀️", "☁️", "🌤️", "🌫️"]


def test_gauges(spark):
    df = spark.createDataFrame([(30.0, 1100, 20000, None, None), (None, None, None, 80, 10)], "w double, p int, v int, h int, c int")
    got = df.select(
        X.gauge_wind_pct("w"), X.gauge_pressure_pct("p"), X.gauge_visibility_pct("v"), X.gauge_humidity_pct("h"), X.gauge_clouds_pct("c")
    ).collect()
    assert tuple(got[0]) == (100, 100, 100, 50, 40)
    assert tuple(got[1]) == (30, 60, 75, 80, 10)


def test_tolerant_int_and_double(spark):
    df = spark.createDataFrame([("55.5",), ("55",), ("55.0",), ("x",), ("NaN",), (None,)], "s string")
    got = df.select(X.to_int("s"), X.to_double("s")).collect()
    assert [r[0] for r in got] == [None, 55, 55, None, None, None]
    assert [r[1] for r in got] == [55.5, 55.0, 55.0, None, None, None]


def test_percent_zero_denominator(spark):
    df = spark.createDataFrame([(2, 3), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(X.percent("a", "b")).collect()] == [66.7, 0.0]


def test_falsy_default(spark):
    df = spark.createDataFrame([(0.0,), (None,), (3.5,)], "x double")
    assert [r[0] for r in df.select(X.falsy_default("x", 10.0)).collect()] == [10.0, 10.0, 3.5]
    assert F is not None


def test_display_datetime_and_run_stamp(spark):
    df = spark.createDataFrame([(datetime(2024, 9, 15, 18, 50, 7),)], "t timestamp_ntz")
    got = df.select(X.display_datetime("t"), X.run_stamp("t")).first()
    assert got[0] == datetime(2024, 9, 15, 18, 50, 7).strftime("%A, %d %B · %I:%M %p")
    assert got[1] == "20240915_185007"

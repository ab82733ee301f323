import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lakestrata.functions.casting import safe_cast_sql
from lakestrata.functions.hashing import record_hash, record_hash_sql
from lakestrata.functions.numeric import round_half_up


def cast_one(spark, value, label, source=None):
    if source is None:
        df = spark.createDataFrame([(value,)], "x string")
    else:
        df = spark.createDataFrame([(value,)], "x double")
    return df.select(F.expr(safe_cast_sql("x", label, df.schema["x"].dataType)).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", [
    ("12", 12), (" 12 ", 12), ("-7", -7), ("700.5", None), ("0x1A", None), ("1e3", None), ("x", None),
    ("", None), (None, None),
])
def test_int64_guard(spark, raw, expected):
    assert cast_one(spark, raw, "INT64") == expected


@pytest.mark.parametrize("raw,expected", [
    ("12.5", 12.5), ("1,000", None), ("1d", None), ("N/A", None), ("--", None), ("-0.25", -0.25),
    ("1e3", 1000.0), (".5", 0.5), ("2%", None),
])
def test_float64_guard(spark, raw, expected):
    assert cast_one(spark, raw, "FLOAT64") == expected


@pytest.mark.parametrize("raw,expected", [
    ("2024-01-15", dt.date(2024, 1, 15)), ("2024-1-5", dt.date(2024, 1, 5)), ("2024", None),
    ("2024-01", None), ("31/12/1980", None), ("2024-13-45", None), ("open", None),
])
def test_date_guard(spark, raw, expected):
    assert cast_one(spark, raw, "DATE") == expected


@pytest.mark.parametrize("raw,expected", [
    ("2024-01-05 10:00:00", dt.datetime(2024, 1, 5, 10, 0)), ("2024-01-05", dt.datetime(2024, 1, 5)),
    ("yesterday", None), ("10:00", None),
])
def test_timestamp_guard(spark, raw, expected):
    assert cast_one(spark, raw, "TIMESTAMP") == expected


def test_double_to_int_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.4,)], "x double")
    got = [r["y"] for r in df.select(F.expr(safe_cast_sql("x", "INT64", DoubleType())).alias("y")).collect()]
    assert got == [3, -3, 1]


@pytest.mark.parametrize(("text", "want"), [
    ("2024-01-15T10:00:00Z", "2024-01-15 10:00:00"), ("2024-01-15 10:00:00+02:00", "2024-01-15 08:00:00"),
    ("2024-01-15 10:00:00-05:30", "2024-01-15 15:30:00"), ("2024-01-15 10:00:00 UTC", "2024-01-15 10:00:00"), ("2024-01-15 10:00:00 here", None),
    ("2024-01-15 10:00:00+02", "2024-01-15 08:00:00"), ("2024-01-15 10:00:00-0330", "2024-01-15 13:30:00"), ("2024-01-15 10:00:00+2:00", "2024-01-15 08:00:00"),
    ("2024-01-15 10:00:00-7", "2024-01-15 17:00:00"), ("2024-07-15 10:00:00 Europe/London", "2024-07-15 09:00:00"), ("2024-01-15 10:00 America/New_York", "2024-01-15 15:00:00"),
    ("2024-01-15 10:00:00.5 America/Argentina/Buenos_Aires", "2024-01-15 13:00:00.5"), ("2024-01-15 10:00:00 Nowhere/City", None), ("2024-01-15 10:00:00+25:00", None), ("2024-01-15+02", None),
])
def test_zoned_timestamps_become_utc(spark, text, want):
    got = spark.createDataFrame([(text,)], "x string").select(F.expr(safe_cast_sql("x", "TIMESTAMP")).cast("string").alias("y")).first()["y"]
    assert got == want


def test_record_hash_is_total_and_tells_values_apart(spark):
    values = [1e15, 1e300, 0.00001, 0.00002, float("nan"), float("inf"), float("-inf"), 0.0, None, 12.34]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["h"] for r in df.select(record_hash(df, ["x"]).alias("h")).collect()]
    assert len(set(got)) == len(values)
    assert [r["h"] for r in df.selectExpr(record_hash_sql(df, ["x"]) + " AS h").collect()] == got


@pytest.mark.parametrize(("x", "want"), [(1.005, 1.01), (-2.345, -2.35), (1e30, 1e30), (float("inf"), float("inf")), (1e15 + 0.5, 1e15 + 0.5), (None, None)])
def test_rounding_keeps_every_value(spark, x, want):
    assert spark.createDataFrame([(x,)], "x double").select(round_half_up(F.col("x"), 2).alias("y")).first()["y"] == want


def test_rounding_keeps_nan(spark):
    got = spark.createDataFrame([(float("nan"),)], "x double").select(round_half_up(F.col("x"), 2).alias("y")).first()["y"]
    assert got != got

"""Hourly series documents: UTC arrays -> New York local hours with real DST rules."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import series

ZONE = "America/New_York"
FIELDS = ["temperature_2m", "precipitation", "rain", "snowfall", "wind_speed_10m", "weather_code"]


def month_doc(year, month, temp=lambda i: 10.0, precip=lambda i: 0.5, zone="GMT", drop_last=0, null_temp_at=None):
    start = dt.datetime(year, month, 1)
    nxt = dt.datetime(year + (month == 12), month % 12 + 1, 1)
    n = ((nxt - start).days + 1) * 24
    times = [(start + dt.timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(n)]
    temps = [None if i == null_temp_at else temp(i) for i in range(n)]
    hourly = {"time": times, "temperature_2m": temps[: n - drop_last], "precipitation": [precip(i) for i in range(n)],
              "rain": [precip(i) for i in range(n)], "snowfall": [0.0] * n, "wind_speed_10m": [float(i % 7) for i in range(n)],
              "weather_code": [i % 4 for i in range(n)]}
    return (year, month, zone, hourly)


DDL = ("year int, month int, timezone string, hourly struct<time: array<string>, temperature_2m: array<double>, "
       "precipitation: array<double>, rain: array<double>, snowfall: array<double>, wind_speed_10m: array<double>, "
       "weather_code: array<int>>")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([month_doc(2025, 3), month_doc(2025, 11, temp=lambda i: float(i % 10))], DDL)


def test_spring_forward_month_has_743_local_hours(spark, docs):
    silver = series.flatten_series(docs, ZONE)
    counts = {(r.year, r.month): r[2] for r in silver.groupBy("year", "month").count().collect()}
    assert counts == {(2025, 3): 743, (2025, 11): 720}
    march = [r.weather_hour for r in silver.filter("month = 3").collect()]
    assert dt.datetime(2025, 3, 9, 2, 0) not in march            # the skipped hour has no row
    assert dt.datetime(2025, 3, 1, 0, 0) in march                 # local month starts at local midnight


def test_fall_back_hour_is_merged(spark, docs):
    hours = series.local_hours(docs, ZONE).filter(F.col("weather_hour") == dt.datetime(2025, 11, 2, 1, 0))
    assert hours.count() == 2                                       # 05:00 and 06:00 UTC
    merged = series.flatten_series(docs, ZONE).filter(F.col("weather_hour") == dt.datetime(2025, 11, 2, 1, 0)).first()
    raw = sorted(r.temperature_c for r in hours.collect())
    assert merged.precipitation_mm == 1.0                            # 0.5 + 0.5: two hours of rain
    assert merged.temperature_c == round((raw[0] + raw[1]) / 2 + 1e-9, 1)
    assert merged.weather_date == dt.date(2025, 11, 2)


def test_month_edge_hours_go_to_their_local_month(spark, docs):
    hours = series.local_hours(docs, ZONE)
    # 2025-03-01 00:00..04:00 UTC are still February in New York: dropped from the March document
    assert hours.filter((F.col("month") == 3) & (F.col("weather_hour") < dt.datetime(2025, 3, 1))).count() == 0
    # the extra UTC day supplies March 31 20:00..23:00 local
    assert hours.filter(F.col("weather_hour") == dt.datetime(2025, 3, 31, 23, 0)).count() == 1


def test_validate_documents_flags_problems(spark):
    bad = spark.createDataFrame([
        month_doc(2025, 3),
        month_doc(2025, 4, drop_last=5),                 # unequal lengths
        month_doc(2025, 5, null_temp_at=10),             # a null temperature
        month_doc(2025, 6, zone="America/New_York"),     # not the expected zone
    ], DDL)
    got = {r.month: r for r in series.validate_documents(bad).collect()}
    assert got[3].valid and got[3].n_hours == got[3].expected_hours == 32 * 24
    assert not got[4].equal_lengths and not got[4].valid
    assert got[5].has_null_required and not got[5].valid
    assert got[6].zone_ok is False and not got[6].valid


def test_unequal_arrays_pad_with_null(spark):
    d = spark.createDataFrame([month_doc(2025, 4, drop_last=5)], DDL)
    rows = series.explode_series(d)
    assert rows.count() == 31 * 24 and rows.filter("temperature_c IS NULL").count() == 5


def test_month_completeness_strict_and_loose(spark, docs):
    silver = series.flatten_series(docs, ZONE)
    got = {r.month: r for r in series.month_completeness(silver, ZONE).collect()}
    assert (got[3].hours, got[3].calendar_hours, got[3].expected_hours) == (743, 744, 743)
    assert got[3].within_tolerance and got[3].complete
    assert (got[11].hours, got[11].expected_hours) == (720, 720) and got[11].complete
    partial = silver.filter(~((F.col("month") == 3) & (F.dayofmonth("weather_hour") == 5)))
    g = {r.month: r for r in series.month_completeness(partial, ZONE).collect()}
    assert not g[3].complete and not g[3].within_tolerance


def test_bad_time_text_becomes_null_not_failure(spark):
    d = spark.createDataFrame([(2025, 1, "GMT", {"time": ["2025-01-01T00:00", "garbage"], "temperature_2m": [1.0, 2.0],
                                                 "precipitation": [0.0, 0.0], "rain": [0.0, 0.0], "snowfall": [0.0, 0.0],
                                                 "wind_speed_10m": [1.0, 1.0], "weather_code": [0, 0]})], DDL)
    assert [r.utc_time for r in series.explode_series(d).collect()] == [dt.datetime(2025, 1, 1), None]


def test_validate_documents_reports_missing_fields(spark):
    ddl = ("year int, month int, timezone string, hourly struct<time: array<string>, "
           "temperature_2m: array<double>, precipitation: array<double>>")
    d = spark.createDataFrame([(2025, 2, "GMT", {"time": ["2025-02-01T00:00"], "temperature_2m": [1.0],
                                                 "precipitation": [0.0]})], ddl)
    r = series.validate_documents(d).first()
    assert r.missing_fields == "rain,snowfall,wind_speed_10m,weather_code" and not r.valid

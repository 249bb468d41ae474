import datetime as dt

from pyspark.sql import functions as F

from lakeshore.functions import (either_in, elapsed, guarded_pct, hour_bucket, iso_day_of_week, month_key,
                                 positive_or_null, round_half_up, surrogate_key, wetness_label)

T0 = dt.datetime(2025, 1, 10, 8, 0, 0)


def test_elapsed_truncates_whole_seconds_then_rounds(spark):
    cases = [(59, 0.98), (60, 1.0), (360 * 60, 360.0), (21601, 360.02), (0, 0.0), (-90, -1.5)]
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(seconds=s), exp) for s, exp in cases],
                               "a timestamp_ntz, b timestamp_ntz, exp double")
    got = df.select(elapsed("a", "b", 60).alias("m"), "exp").collect()
    assert all(r.m == r.exp for r in got), got
    # sub-second parts are dropped, as timestampdiff does: 59.9 s -> 59 s -> 0.98
    frac = spark.createDataFrame([(T0, T0 + dt.timedelta(seconds=59, microseconds=900000))], "a timestamp_ntz, b timestamp_ntz")
    assert frac.select(elapsed("a", "b")).first()[0] == 0.98


def test_hour_bucket_is_ntz_and_exact(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 9, 2, 30, 59),)], "t timestamp_ntz")
    r = df.select(hour_bucket("t").alias("h"))
    assert r.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert r.first().h == dt.datetime(2025, 3, 9, 2, 0, 0)  # the spring-gap hour is kept as written


def test_positive_or_null(spark):
    df = spark.createDataFrame([(0,), (-1,), (None,), (3,)], "p int")
    assert [r[0] for r in df.select(positive_or_null("p")).collect()] == [None, None, None, 3]


def test_guarded_pct_only_for_card_and_positive_fare(spark):
    df = spark.createDataFrame(
        [(1, "10.00", "2.00"), (1, "0.00", "1.00"), (2, "10.00", "2.00"), (1, None, "1.00"), (1, "3.00", "1.00")],
        "pay int, fare string, tip string").select(
        "pay", F.col("fare").cast("decimal(12,2)").alias("fare"), F.col("tip").cast("decimal(12,2)").alias("tip"))
    got = [r[0] for r in df.select(guarded_pct("tip", "fare", F.col("pay") == 1)).collect()]
    assert got == [20.0, None, None, None, 33.33]


def test_either_in_is_three_valued(spark):
    df = spark.createDataFrame([(None, 132), (None, 5), (1, None), (7, 8)], "pu int, do int")
    assert [r[0] for r in df.select(either_in([1, 132, 138], "pu", "do")).collect()] == [True, None, True, False]


def test_wetness_label_order(spark):
    cases = [(None, 0.1, "snow"), (None, None, "unknown"), (0.0, 0.0, "dry"), (2.5, 0.0, "light rain"),
             (2.51, 0.0, "heavy rain"), (0.0, None, "dry"), (None, 0.0, "unknown")]
    df = spark.createDataFrame(cases, "p double, s double, exp string")
    got = df.select(wetness_label("p", "s").alias("l"), "exp").collect()
    assert all(r.l == r.exp for r in got), got


def test_round_half_up_removes_float_noise(spark):
    df = spark.createDataFrame([(28.549999999999997,), (2.675,), (-0.125,), (1.005,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 1)).collect()][:1] == [28.6]
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()][1:] == [2.68, -0.13, 1.01]


def test_surrogate_key_null_placeholder_and_stability(spark):
    df = spark.createDataFrame([(1, None), (1, "")], "a int, b string")
    k = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert k[0] != k[1] and all(len(x) == 32 for x in k)


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 3, 9),)], "d date")
    got = df.select(iso_day_of_week("d"), month_key("d"), F.weekofyear("d"), F.year("d")).collect()
    assert tuple(got[0]) == (1, "2024-12", 1, 2024)   # ISO week 1, calendar year 2024
    assert tuple(got[1])[:2] == (7, "2025-03")


def test_batch_month_for(spark):
    from lakeshore.functions import batch_month_for

    df = spark.createDataFrame([(dt.date(2025, 5, 17),), (dt.date(2025, 1, 1),)], "d date")
    assert [r[0] for r in df.select(batch_month_for("d")).collect()] == [dt.date(2025, 3, 1), dt.date(2024, 11, 1)]

"""Queries of the hourly weather series: documents of parallel UTC arrays -> local hours."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions import round_half_up, wetness_label
from lakeshore.operators import series
from lakeshore.plans import standins
from lakeshore.plans.catalog import query
from lakeshore.plans.oracle import WEATHER_CTES, register, rhu
from lakeshore.session import require_utc, scratch_path
from lakeshore.sources.documents import WEATHER_DOC_DDL, read_json, write_json_documents

ZONE = standins.LOCAL_ZONE


def with_weather(body: str, *extra: str) -> str:
    return "WITH " + ",".join([WEATHER_CTES, *extra]) + "\n" + body


def documents(spark: SparkSession, root: str) -> DataFrame:
    require_utc(spark)
    return standins.weather_documents(spark, root)


def silver_weather(spark: SparkSession, root: str) -> DataFrame:
    return series.flatten_series(documents(spark, root), ZONE)


def landed(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """The documents as files of one JSON object each, read back as multi-line JSON."""
    path = scratch_path(spark, name)
    write_json_documents(docs, path)
    return read_json(spark, path, WEATHER_DOC_DDL, multi_line=True)


@query("series_explode")
def q_series_explode(spark: SparkSession, root: str) -> DataFrame:
    return series.explode_series(landed(spark, documents(spark, root), "weather-json"))


register("series_explode", with_weather("""
SELECT year, month, utc_time, temperature_c, precipitation_mm, rain_mm, snowfall_cm, wind_speed_kmh, weather_code
FROM wx_utc"""))


@query("series_local_time")
def q_series_local_time(spark: SparkSession, root: str) -> DataFrame:
    return series.local_hours(documents(spark, root), ZONE)


register("series_local_time", with_weather("SELECT * FROM wx_own"))


@query("dst_merge")
def q_dst_merge(spark: SparkSession, root: str) -> DataFrame:
    return silver_weather(spark, root)


register("dst_merge", with_weather("SELECT * FROM weather"))


@query("series_validate")
def q_series_validate(spark: SparkSession, root: str) -> DataFrame:
    return series.validate_documents(landed(spark, standins.broken_documents(documents(spark, root)), "broken-json"))


register("series_validate", with_weather(f"""
SELECT *, missing_fields IS NULL AND n_hours = expected_hours AND equal_lengths AND NOT has_null_required AND zone_ok AS valid
FROM (
  SELECT year, month, CASE WHEN month = {standins.LOST_FIELD_MONTH} THEN 'snowfall' END AS missing_fields,
         CAST(count(*) AS INTEGER) AS n_hours,
         CAST((datediff('day', min(month_start), last_day(min(month_start))) + 2) * 24 AS INTEGER) AS expected_hours,
         month <> {standins.SHORT_ARRAY_MONTH} AS equal_lengths,
         month = {standins.NULL_READING_MONTH} OR bool_or(temperature_c IS NULL) AS has_null_required,
         month <> {standins.WRONG_ZONE_MONTH} AS zone_ok
  FROM wx_utc JOIN months USING (year, month)
  GROUP BY year, month)"""))


@query("month_completeness")
def q_month_completeness(spark: SparkSession, root: str) -> DataFrame:
    return series.month_completeness(silver_weather(spark, root), ZONE)


register("month_completeness", with_weather(f"""
SELECT h.year, h.month, h.hours, h.null_required_hours, e.expected_hours,
       CAST(day(last_day(make_date(h.year, h.month, 1))) * 24 AS INTEGER) AS calendar_hours,
       abs(h.hours - day(last_day(make_date(h.year, h.month, 1))) * 24) <= 1 AS within_tolerance,
       h.hours = e.expected_hours AND h.null_required_hours = 0 AS complete
FROM held h LEFT JOIN expected e USING (year, month)""", """
held AS (SELECT year, month, count(*) AS hours, count(*) FILTER (WHERE temperature_c IS NULL) AS null_required_hours
         FROM weather GROUP BY year, month)""", f"""
expected AS (
  SELECT year, month, count(DISTINCT h) AS expected_hours FROM (
    SELECT year, month, timezone('{ZONE}', timezone('UTC', u)) AS h FROM (
      SELECT year, month, unnest(generate_series(CAST(make_date(year, month, 1) AS TIMESTAMP) - INTERVAL 1 DAY,
                                                 CAST(make_date(year, month, 1) + INTERVAL 1 MONTH AS TIMESTAMP) + INTERVAL 1 DAY,
                                                 INTERVAL 1 HOUR)) AS u
      FROM held))
  WHERE year(h) = year AND month(h) = month
  GROUP BY year, month)"""))


@query("daily_summary")
def q_daily_summary(spark: SparkSession, root: str) -> DataFrame:
    return silver_weather(spark, root).groupBy("weather_date").agg(
        round_half_up(F.avg("temperature_c"), 1).alias("avg_temperature_c"),
        round_half_up(F.sum("precipitation_mm"), 1).alias("total_precipitation_mm"),
        round_half_up(F.sum("snowfall_cm"), 1).alias("total_snowfall_cm"),
    )


register("daily_summary", with_weather(f"""
SELECT weather_date, {rhu("avg(temperature_c)", 1)} AS avg_temperature_c,
       {rhu("sum(precipitation_mm)", 1)} AS total_precipitation_mm,
       {rhu("sum(snowfall_cm)", 1)} AS total_snowfall_cm
FROM weather GROUP BY weather_date"""))


@query("bucket_label")
def q_bucket_label(spark: SparkSession, root: str) -> DataFrame:
    w = silver_weather(spark, root)
    return w.select("weather_hour", "precipitation_mm", "snowfall_cm",
                    wetness_label("precipitation_mm", "snowfall_cm").alias("weather_label"))


register("bucket_label", with_weather("""
SELECT weather_hour, precipitation_mm, snowfall_cm,
  CASE WHEN snowfall_cm > 0 THEN 'snow' WHEN precipitation_mm IS NULL THEN 'unknown'
       WHEN precipitation_mm = 0 THEN 'dry' WHEN precipitation_mm <= 2.5 THEN 'light rain'
       ELSE 'heavy rain' END AS weather_label
FROM weather"""))

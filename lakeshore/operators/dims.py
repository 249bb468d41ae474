"""Dimensions: gap-free date spine, date dimension, holidays for a region, lookup flags."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions import is_weekend, iso_day_of_week


def date_spine(df: DataFrame, col: str, out: str = "date_day") -> DataFrame:
    """Every date from min(col) to max(col) inclusive (0 rows when the column is all null).
    One partial aggregate per task, then one row is exploded: no shuffle of the input rows."""
    bounds = df.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(out))


def holidays_for(holidays: DataFrame, region_code: str, date_col: str = "holiday_date",
                 name_col: str = "holiday_name", nationwide_col: str = "is_nationwide",
                 observed_col: str = "observed_in", separator: str = " / ") -> DataFrame:
    """One row per date that is a holiday in the region: nationwide ones plus those whose
    observed-in list mentions ``region_code`` (null or null drops the row). Names of
    holidays sharing a date are joined in name order, so the date is unique."""
    keep = holidays.filter(F.col(nationwide_col) | F.col(observed_col).contains(region_code))
    return keep.groupBy(date_col).agg(
        F.array_join(F.array_sort(F.collect_list(name_col)), separator).alias(name_col),
        F.bool_or(nationwide_col).alias(nationwide_col),
    )


def date_dim(spine: DataFrame, holidays: DataFrame | None = None, daily: DataFrame | None = None,
             day_col: str = "date_day", holiday_date: str = "holiday_date", daily_date: str = "weather_date"
             ) -> DataFrame:
    """Calendar attributes of each spine date, holiday flag and name, daily measures.
    Day and month names are emitted unpadded. All three inputs are one row per date (a
    calendar-sized table on each side), so no side is hinted; AQE picks the join."""
    d = F.col(day_col)
    out = spine.select(
        d.alias("date_key"),
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day_of_month"),
        iso_day_of_week(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"), F.weekofyear(d).alias("iso_week"),
        is_weekend(d).alias("is_weekend"),
    )
    if holidays is not None:
        h = holidays.select(F.col(holiday_date).alias("__hd"), "holiday_name")
        out = (out.join(h, out.date_key == h.__hd, "left")
               .withColumn("is_holiday", F.col("__hd").isNotNull()).drop("__hd"))
    if daily is not None:
        dd = daily.withColumnRenamed(daily_date, "__dd")
        out = out.join(dd, out.date_key == dd.__dd, "left").drop("__dd")
    return out


def flag_in(col: str, values: Sequence) -> Column:
    return F.col(col).isin(list(values))


def zone_dim(zones: DataFrame, airport_ids: Sequence[int], unknown_boroughs: Sequence[str]) -> DataFrame:
    """Zone dimension with airport and unknown flags (ids, not names: names repeat)."""
    return zones.select(
        F.col("location_id").alias("zone_id"), F.col("zone").alias("zone_name"), "borough", "service_zone",
        flag_in("location_id", airport_ids).alias("is_airport"),
        flag_in("borough", unknown_boroughs).alias("is_unknown"),
    )

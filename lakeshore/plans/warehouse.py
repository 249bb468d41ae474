"""Silver -> gold: staging of weather and holidays, region holidays, the enriched trip view,
the fact table, the date dimension and the hourly mart anchored on weather hours."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions import is_weekend, iso_day_of_week, month_key, round_half_up, wetness_label
from lakeshore.operators import dims, facts
from lakeshore.operators.enrich import Lookup, enrich
from lakeshore.sources import lookups

WEATHER_MEASURES = ["temperature_c", "precipitation_mm", "rain_mm", "snowfall_cm",
                    "wind_speed_kmh", "weather_code"]


def stage_holidays(records: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """JSON-shaped holiday records -> typed rows; list columns flattened to comma text,
    a null list stays null (``concat_ws`` alone would turn it into '')."""
    return records.select(
        F.to_date("date").alias("holiday_date"),
        F.col("name").alias("holiday_name"),
        F.col("localName").alias("holiday_local_name"),
        F.col("global").alias("is_nationwide"),
        F.when(F.col("counties").isNotNull(), F.concat_ws(",", "counties")).alias("observed_in"),
        F.when(F.col("types").isNotNull(), F.concat_ws(",", "types")).alias("holiday_types"),
        *([loaded_at.alias("loaded_at")] if loaded_at is not None else []),
    )


def weather_with_codes(weather: DataFrame, codes: DataFrame) -> DataFrame:
    """The chained lookup: weather hour -> code -> description/category, pre-joined on the
    small side so the fact meets one lookup. A frame that already carries the code columns
    (a stored, coded weather table) is returned as it is."""
    if "weather_category" in weather.columns:
        return weather
    return enrich(weather, [Lookup(codes, {"weather_code": "weather_code"},
                                   {"weather_description": "weather_description",
                                    "weather_category": "weather_category"}, broadcast=True)])


def zones_lookup_check(zones: DataFrame):
    """The zone table is data (not a fixed list): its key must be verified before joins."""
    from lakeshore.operators.enrich import assert_all_unique
    return lambda: assert_all_unique([Lookup(zones, {"location_id": "location_id"}, {}, name="zones")])


def enrich_trips(spark: SparkSession, trips: DataFrame, weather: DataFrame, zones: DataFrame,
                 holidays_region: DataFrame, check_unique: bool = False, zones_verified: bool = False) -> DataFrame:
    """Staged trips + pickup-hour weather, zones (role-playing: pickup and dropoff),
    code names and the region's holidays. Same row count as ``trips``.

    The fixed code lists are broadcast. Zones, weather hours and holiday dates are data: the
    planner's statistics (the file size of a stored table) and its broadcast threshold decide, with
    a sort-merge join beyond it."""
    wx = weather_with_codes(weather, lookups.weather_codes(spark)).select(
        "weather_hour", *WEATHER_MEASURES, "weather_description", "weather_category")
    out = enrich(trips, [
        Lookup(wx, {"pickup_hour": "weather_hour"},
               {c: c for c in [*WEATHER_MEASURES, "weather_description", "weather_category"]},
               name="weather"),
        Lookup(zones, {"pickup_location_id": "location_id"},
               {"borough": "pickup_borough", "zone": "pickup_zone"}, name="zones",
               verify_unique=not zones_verified),
        Lookup(zones, {"dropoff_location_id": "location_id"},
               {"borough": "dropoff_borough", "zone": "dropoff_zone"}, name="dropoff_zone"),
        Lookup(lookups.payment_types(spark), {"payment_type": "payment_type"},
               {"payment_type_name": "payment_type_name"}, broadcast=True, name="payment_types"),
        Lookup(lookups.rate_codes(spark), {"ratecode_id": "ratecode_id"},
               {"ratecode_name": "ratecode_name"}, broadcast=True, name="rate_codes"),
        Lookup(holidays_region, {"pickup_date": "holiday_date"},
               {"holiday_date": "__holiday_date", "holiday_name": "holiday_name"},
               name="holidays"),
    ], check_unique=check_unique)
    return (
        out.withColumn("pickup_hour_of_day", F.hour("pickup_at"))
        .withColumn("pickup_day_of_week", iso_day_of_week("pickup_at"))
        .withColumn("is_weekend", is_weekend("pickup_at"))
        .withColumn("is_holiday", F.col("__holiday_date").isNotNull())
        .drop("__holiday_date")
    )


# The columns of the fact, in order.
FACT_COLUMNS = [
    "trip_id", "date_key", "pickup_zone_id", "dropoff_zone_id", "pickup_at", "dropoff_at",
    "pickup_hour", "pickup_hour_of_day", "is_weekend", "is_holiday", "duration_min",
    "trip_distance_miles", "passenger_count", "is_airport_trip", "payment_type_name",
    "ratecode_name", "fare_amount", "tip_amount", "tip_pct", "total_amount", "temperature_c",
    "precipitation_mm", "snowfall_cm", "wind_speed_kmh", "weather_category", "source_month", "loaded_at",
]


def fact_trips(enriched: DataFrame) -> DataFrame:
    """The narrow star fact: keys into the dimensions, trip measures, pickup-hour weather and
    the batch key ``source_month``."""
    return (enriched
            .withColumnRenamed("pickup_date", "date_key")
            .withColumnRenamed("pickup_location_id", "pickup_zone_id")
            .withColumnRenamed("dropoff_location_id", "dropoff_zone_id")
            .withColumn("source_month", month_key("pickup_at"))
            .select(*FACT_COLUMNS))


def dim_date(enriched: DataFrame, holidays_region: DataFrame, weather: DataFrame) -> DataFrame:
    """Every date between the first and last pickup, with calendar parts, holiday flag and
    the day's weather summary."""
    spine = dims.date_spine(enriched, "pickup_date")
    daily = weather.groupBy("weather_date").agg(
        round_half_up(F.avg("temperature_c"), 1).alias("avg_temperature_c"),
        round_half_up(F.sum("precipitation_mm"), 1).alias("total_precipitation_mm"),
        round_half_up(F.sum("snowfall_cm"), 1).alias("total_snowfall_cm"),
    )
    return dims.date_dim(spine, holidays_region, daily)


MART_COLUMNS = [
    "hour_key", "date_key", "hour_of_day", "day_of_week", "is_weekend", "is_holiday", "trips",
    "passengers", "avg_duration_min", "avg_distance_miles", "avg_total_amount", "avg_tip_pct",
    "airport_trips", "temperature_c", "precipitation_mm", "rain_mm", "snowfall_cm",
    "wind_speed_kmh", "weather_category", "weather_label",
]


def hourly_mart(spark: SparkSession, fact: DataFrame | None, weather: DataFrame, holidays_region: DataFrame,
                by_hour: DataFrame | None = None) -> DataFrame:
    """One row per weather hour: trip counts and means of that hour next to its weather.
    Anchored on weather: an hour without trips has trips = 0 and airport_trips = 0, the
    means stay null; dates outside the fact's range get null day flags.

    The date dimension's range comes from the hourly aggregate (min/max of its hours), the
    same subtree the mart joins, so the fact is scanned and aggregated once (exchange reuse)."""
    by_hour = by_hour if by_hour is not None else facts.hourly_demand(fact, "pickup_hour")
    dates = dim_date(by_hour.select(F.to_date("pickup_hour").alias("pickup_date")), holidays_region, weather)
    wx = weather_with_codes(weather, lookups.weather_codes(spark))
    day = dates.select(F.col("date_key").alias("__dk"), "day_of_week", "is_weekend", "is_holiday")
    base = (wx.select(F.col("weather_hour").alias("hour_key"), F.col("weather_date").alias("date_key"),
                      *WEATHER_MEASURES[:-1], "weather_category")
            .join(day, F.col("date_key") == F.col("__dk"), "left").drop("__dk"))
    mart = facts.anchored(base, by_hour, ("hour_key", "pickup_hour"), zero_fill=["trips", "airport_trips"])
    return (mart.withColumn("hour_of_day", F.hour("hour_key"))
            .withColumn("weather_label", wetness_label("precipitation_mm", "snowfall_cm"))
            .select(*MART_COLUMNS))

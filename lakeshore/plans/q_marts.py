"""Queries of the gold layer: holidays, lookups, star enrichment, dimensions, fact, marts."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators import dims, facts
from lakeshore.plans import standins, warehouse
from lakeshore.plans.catalog import query
from lakeshore.plans.oracle import (DIM_DATE_CTE, ENRICHED_CTE, FCT_CTE, MART_CTE, register, with_all)
from lakeshore.plans.q_clean import staged
from lakeshore.plans.q_series import silver_weather
from lakeshore.session import materialize, materialize_all, scratch_path
from lakeshore.sources import documents, lookups

UNKNOWN_BOROUGHS = ("Unknown", "N/A")


def holiday_rows(spark: SparkSession, root: str) -> DataFrame:
    return warehouse.stage_holidays(standins.holiday_records(spark, root))


def holidays_region(spark: SparkSession, root: str) -> DataFrame:
    return dims.holidays_for(holiday_rows(spark, root), standins.STANDIN_REGION_CODE)


def weather_table(spark: SparkSession, root: str) -> DataFrame:
    """Silver weather, written once per run (calendar-sized) and re-read by every consumer."""
    return materialize(spark, silver_weather(spark, root), "silver-weather")


def dimension_tables(spark: SparkSession, root: str, checks=()) -> tuple[DataFrame, DataFrame]:
    """(weather, holidays) written once per run, as two concurrent jobs (plus ``checks``)."""
    # weather is stored with its code names joined: the stored table's statistics are then
    # its file size, which the planner's broadcast threshold uses (a join's estimate is not)
    coded = warehouse.weather_with_codes(silver_weather(spark, root), lookups.weather_codes(spark))
    t = materialize_all(spark, {"silver-weather": coded, "holidays-region": holidays_region(spark, root)}, checks)
    return t["silver-weather"], t["holidays-region"]


def enriched(spark: SparkSession, root: str, check_unique: bool = False, weather: DataFrame | None = None,
             holidays: DataFrame | None = None, trips: DataFrame | None = None) -> DataFrame:
    zones = standins.zones(spark, root)
    checks = [warehouse.zones_lookup_check(zones)]
    if weather is None or holidays is None:
        weather, holidays = dimension_tables(spark, root, checks)
    else:
        checks[0]()
    return warehouse.enrich_trips(spark, staged(spark, root, trips), weather, zones, holidays,
                                  check_unique, zones_verified=True)


def fact(spark: SparkSession, root: str, weather: DataFrame | None = None,
         holidays: DataFrame | None = None, trips: DataFrame | None = None) -> DataFrame:
    return warehouse.fact_trips(enriched(spark, root, weather=weather, holidays=holidays, trips=trips))


@query("holiday_flatten")
def q_holiday_flatten(spark: SparkSession, root: str) -> DataFrame:
    """Records land as one JSON array per year in the shared scratch area and are read back
    as multi-line JSON with a schema."""
    path = scratch_path(spark, "holidays-json")
    documents.write_json_arrays(standins.holiday_records(spark, root), path, F.substring("date", 1, 4))
    return warehouse.stage_holidays(documents.read_json(spark, path, documents.HOLIDAY_DDL, multi_line=True))


register("holiday_flatten", with_all("SELECT * FROM stg_holidays"))


@query("holidays_region")
def q_holidays_region(spark: SparkSession, root: str) -> DataFrame:
    return holidays_region(spark, root)


register("holidays_region", with_all("SELECT * FROM holidays_region"))


@query("lookup_load")
def q_lookup_load(spark: SparkSession, root: str) -> DataFrame:
    """The zone lookup round-trips through a quoted CSV with a fixed schema."""
    path = scratch_path(spark, "zones-csv")
    lookups.write_lookup_csv(standins.zones(spark, root), path)
    return lookups.read_lookup_csv(spark, path, lookups.ZONE_DDL)


register("lookup_load", with_all("SELECT CAST(location_id AS INTEGER) AS location_id, borough, zone, service_zone FROM zones"))


@query("dim_lookup")
def q_dim_lookup(spark: SparkSession, root: str) -> DataFrame:
    return dims.zone_dim(standins.zones(spark, root), standins.STANDIN_AIRPORT_ZONES, UNKNOWN_BOROUGHS)


register("dim_lookup", with_all("""
SELECT CAST(location_id AS INTEGER) AS zone_id, zone AS zone_name, borough, service_zone,
       location_id IN (1, 13, 24) AS is_airport, borough IN ('Unknown', 'N/A') AS is_unknown
FROM zones"""))


@query("enrich_star")
def q_enrich_star(spark: SparkSession, root: str) -> DataFrame:
    return enriched(spark, root)


register("enrich_star", with_all("SELECT * FROM enriched", ENRICHED_CTE))


@query("date_spine")
def q_date_spine(spark: SparkSession, root: str) -> DataFrame:
    return dims.date_spine(staged(spark, root), "pickup_date")


register("date_spine", with_all("""
SELECT CAST(unnest(generate_series(min(pickup_date), max(pickup_date), INTERVAL 1 DAY)) AS DATE) AS date_day
FROM stg"""))


@query("dim_date")
def q_dim_date(spark: SparkSession, root: str) -> DataFrame:
    weather, holidays = dimension_tables(spark, root)
    return warehouse.dim_date(staged(spark, root), holidays, weather)


register("dim_date", with_all("SELECT * FROM dim_date", ENRICHED_CTE, DIM_DATE_CTE))


@query("fact_build")
def q_fact_build(spark: SparkSession, root: str) -> DataFrame:
    return fact(spark, root)


register("fact_build", with_all("SELECT * FROM fct", ENRICHED_CTE, FCT_CTE))


@query("hourly_demand")
def q_hourly_demand(spark: SparkSession, root: str) -> DataFrame:
    return facts.hourly_demand(fact(spark, root), "pickup_hour")


register("hourly_demand", with_all("SELECT * FROM by_hour", ENRICHED_CTE, FCT_CTE, DIM_DATE_CTE, MART_CTE))


def mart(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(stored fact, mart). The fact is written once; the mart is an aggregate of what is stored."""
    weather, holidays = dimension_tables(spark, root)
    stored = materialize(spark, fact(spark, root, weather, holidays), "fct-trips")
    return stored, warehouse.hourly_mart(spark, stored, weather, holidays)


@query("hourly_mart")
def q_hourly_mart(spark: SparkSession, root: str) -> DataFrame:
    return mart(spark, root)[1]


register("hourly_mart", with_all("SELECT * FROM mart", ENRICHED_CTE, FCT_CTE, DIM_DATE_CTE, MART_CTE))


@query("reconcile_totals")
def q_reconcile_totals(spark: SparkSession, root: str) -> DataFrame:
    """Failing rows of "hourly totals add back up to the fact's trips": a trip whose pickup
    hour has no weather row (the skipped spring-forward hour) vanishes from the mart."""
    stored, m = mart(spark, root)
    return facts.totals_mismatch(stored, m, F.count(F.lit(1)), F.sum("trips"),
                                 {"left": "fct_trips", "right": "agg_trips"})


register("reconcile_totals", with_all("""
SELECT fct_trips, agg_trips FROM
  (SELECT count(*) AS fct_trips FROM fct) CROSS JOIN (SELECT CAST(sum(trips) AS BIGINT) AS agg_trips FROM mart)
WHERE fct_trips IS DISTINCT FROM agg_trips""", ENRICHED_CTE, FCT_CTE, DIM_DATE_CTE, MART_CTE))

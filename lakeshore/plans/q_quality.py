"""Queries of data quality (expectations), profiling and the small analytic queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions import elapsed, round_half_up
from lakeshore.operators import expect, profile, stored_profile
from lakeshore.operators.contract import conform
from lakeshore.operators.unique import repeated_keys
from lakeshore.plans import standins
from lakeshore.plans.catalog import query
from lakeshore.plans.oracle import ENRICHED_CTE, WEATHER_CTES, register, rhu, with_all, with_trips
from lakeshore.plans.pipelines import batch_loaded_at
from lakeshore.plans.q_clean import silver, staged
from lakeshore.plans.q_marts import enriched
from lakeshore.plans.q_series import silver_weather
from lakeshore.plans.trips import row_checks
from lakeshore.session import materialize, scratch_path
from lakeshore.sources.lookups import RATE_CODES
from lakeshore.sources.tables import table

P = standins.STANDIN_TRIPS
FRESHNESS_NOW = "2001-10-01 00:00:00"
SUMMARY_COLUMNS = ["trip_distance", "fare_amount", "tip_amount", "total_amount", "passenger_count", "duration_min"]
SUMMARY_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]
UNKNOWN_ZONE_IDS = (264, 265)


def profiled(spark: SparkSession, root: str) -> DataFrame:
    """Conformed bronze trips plus elapsed duration: what a profile of a raw batch looks at."""
    c = conform(standins.raw_trips(spark, root), P.contract, keep=["year", "month"])
    return c.withColumn("duration_min", elapsed("pickup_datetime", "dropoff_datetime", P.duration_unit_seconds))


PROFILED_SQL = f"""
profiled AS (
  SELECT *, {rhu("CAST(date_sub('second', pickup_datetime, dropoff_datetime) AS DOUBLE) / 60.0", 2)} AS duration_min
  FROM conformed)"""


def with_profiled(body: str, *extra: str) -> str:
    return with_trips(body, PROFILED_SQL, *extra)


# ---------------------------------------------------------------- expectations

@query("expect_not_null")
def q_expect_not_null(spark: SparkSession, root: str) -> DataFrame:
    return expect.not_null(silver_weather(spark, root), "precipitation_mm")


register("expect_not_null", "WITH " + WEATHER_CTES + "\nSELECT * FROM weather WHERE precipitation_mm IS NULL")


@query("expect_unique")
def q_expect_unique(spark: SparkSession, root: str) -> DataFrame:
    return expect.unique(table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


register("expect_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")


@query("expect_unique_hashed")
def q_expect_unique_hashed(spark: SparkSession, root: str) -> DataFrame:
    """Lines of equal part, quantity and discount (some per cent of them), found by counting hashes first."""
    return repeated_keys(table(spark, root, "lineitem"), ["l_partkey", "l_quantity", "l_discount"])


register("expect_unique_hashed", """
SELECT l_partkey, l_quantity, l_discount, count(*) AS n_rows FROM lineitem
WHERE l_partkey IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL
GROUP BY ALL HAVING count(*) > 1""")


@query("expect_relationships")
def q_expect_relationships(spark: SparkSession, root: str) -> DataFrame:
    orphans = expect.relationships(staged(spark, root), "pickup_hour", silver_weather(spark, root), "weather_hour")
    return orphans.select("trip_id", "pickup_at", "pickup_hour")


register("expect_relationships", with_all("""
SELECT trip_id, pickup_at, pickup_hour FROM stg
WHERE pickup_hour IS NOT NULL AND pickup_hour NOT IN (SELECT weather_hour FROM weather WHERE weather_hour IS NOT NULL)"""))


@query("expect_accepted_values")
def q_expect_accepted_values(spark: SparkSession, root: str) -> DataFrame:
    codes = [c for c, _ in RATE_CODES]
    return expect.accepted_values(staged(spark, root), "ratecode_id", codes).select("trip_id", "ratecode_id")


register("expect_accepted_values", with_all(f"""
SELECT trip_id, ratecode_id FROM stg
WHERE ratecode_id IS NOT NULL AND ratecode_id NOT IN ({", ".join(str(c) for c, _ in RATE_CODES)})"""))


@query("expect_range")
def q_expect_range(spark: SparkSession, root: str) -> DataFrame:
    return expect.in_range(profiled(spark, root), "trip_distance", 0, P.max_distance).select(
        "vendor_id", "pickup_datetime", "trip_distance")


register("expect_range", with_profiled("""
SELECT vendor_id, pickup_datetime, trip_distance FROM profiled
WHERE trip_distance IS NOT NULL AND (trip_distance < 0 OR trip_distance > 100)"""))


@query("expect_equal_rowcount")
def q_expect_equal_rowcount(spark: SparkSession, root: str) -> DataFrame:
    return expect.equal_rowcount(enriched(spark, root), staged(spark, root))


register("expect_equal_rowcount", with_all("""
SELECT left_rows, right_rows, left_rows = right_rows AS passed
FROM (SELECT count(*) AS left_rows FROM enriched) CROSS JOIN (SELECT count(*) AS right_rows FROM stg)""",
                                            ENRICHED_CTE))


@query("expect_row_rule")
def q_expect_row_rule(spark: SparkSession, root: str) -> DataFrame:
    """Trips that do not end after their start, among the rows as landed."""
    return expect.rows(profiled(spark, root), F.col("dropoff_datetime") <= F.col("pickup_datetime")).select(
        "vendor_id", "pickup_datetime", "dropoff_datetime", "duration_min")


register("expect_row_rule", with_profiled("""
SELECT vendor_id, pickup_datetime, dropoff_datetime, duration_min FROM profiled
WHERE dropoff_datetime <= pickup_datetime"""))


@query("expect_freshness")
def q_expect_freshness(spark: SparkSession, root: str) -> DataFrame:
    trips = expect.freshness(staged(spark, root), "loaded_at", FRESHNESS_NOW, 35, 60, "trips")
    weather = silver_weather(spark, root).withColumn("loaded_at", batch_loaded_at())
    wx = expect.freshness(weather, "loaded_at", FRESHNESS_NOW, 35, 60, "weather")
    return trips.unionByName(wx)


def _fresh_sql(source: str, rel: str) -> str:
    age = f"round(date_sub('second', max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}') / 86400.0, 3)"
    return f"""
SELECT '{source}' AS source, max_loaded_at, {age} AS age_days,
  CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN {age} > 60 THEN 'error' WHEN {age} > 35 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(loaded_at) AS max_loaded_at FROM {rel})"""


register("expect_freshness", with_all(
    _fresh_sql("trips", "stg") + "\nUNION ALL\n" + _fresh_sql("weather", "weather_loaded"), """
weather_loaded AS (
  SELECT CAST(make_date(year, month, 1) + INTERVAL 1 MONTH AS TIMESTAMP) + INTERVAL 78 HOUR AS loaded_at FROM weather)"""))


@query("record_validate")
def q_record_validate(spark: SparkSession, root: str) -> DataFrame:
    """Faulty holiday records: no name, no calendar date, a date outside the batch's year; and the years of
    orders without any record."""
    recs = standins.broken_records(standins.holiday_records(spark, root))
    day = F.try_to_date("date", "yyyy-MM-dd")
    problem = (F.when(F.coalesce(F.trim("name"), F.lit("")) == "", "no name").when(day.isNull(), "no date")
               .when(F.year(day) != F.col("year"), "wrong year"))
    bad = expect.rows(recs.withColumn("problem", problem), F.col("problem").isNotNull())
    years = table(spark, root, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    empty = years.join(recs, "year", "left_anti").select("year", F.lit(None).cast("string").alias("date"),
                                                         F.lit(None).cast("string").alias("name"), F.lit("no records").alias("problem"))
    return bad.select("year", "date", "name", "problem").unionByName(empty)


register("record_validate", with_all(f"""
SELECT * FROM (
  SELECT year, date, name, CASE WHEN trim(coalesce(name, '')) = '' THEN 'no name'
              WHEN try_strptime(date, '%Y-%m-%d') IS NULL THEN 'no date'
              WHEN year(try_strptime(date, '%Y-%m-%d')) <> year THEN 'wrong year' END AS problem
  FROM broken) WHERE problem IS NOT NULL
UNION ALL
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER), NULL, NULL, 'no records' FROM orders
WHERE year(o_orderdate) NOT IN (SELECT year FROM broken)""", f"""
broken AS (
  SELECT CAST(year(d) AS INTEGER) AS year,
         CASE WHEN month(d) = 2 THEN strftime(d, '%Y-') || '02-30'
              WHEN month(d) = 4 THEN strftime(d + INTERVAL 12 MONTH, '%Y-%m-%d') ELSE date END AS date,
         CASE WHEN month(d) = 6 THEN '' WHEN month(d) = 8 THEN NULL ELSE name END AS name
  FROM (SELECT *, CAST(strptime(date, '%Y-%m-%d') AS DATE) AS d FROM holiday_records)
  WHERE year(d) <> {standins.EMPTY_YEAR})"""))


@query("expect_summary")
def q_expect_summary(spark: SparkSession, root: str) -> DataFrame:
    """The gold build's test suite evaluated in one job: failures per expectation."""
    from lakeshore.plans.q_marts import weather_table

    # trips and weather are checked several times: stored once
    w = weather_table(spark, root)
    s = materialize(spark, staged(spark, root).select("trip_id", "pickup_hour", "ratecode_id", "pickup_at", "dropoff_at"), "staged-trips")
    return expect.run([
        expect.row_check("stg_trip_id_not_null", s, expect.not_null_condition("trip_id")),
        expect.Expectation("stg_trip_id_unique", expect.unique(s, "trip_id"), "warn"),
        expect.Expectation("stg_pickup_hour_in_weather", expect.relationships(s, "pickup_hour", w, "weather_hour")),
        expect.row_check("stg_ratecode_accepted", s,
                         expect.accepted_values_condition("ratecode_id", [c for c, _ in RATE_CODES])),
        expect.Expectation("weather_hour_unique", expect.unique(w, "weather_hour")),
        expect.row_check("weather_temperature_range", w, expect.in_range_condition("temperature_c", -30, 45)),
        expect.row_check("weather_precipitation_range", w, expect.in_range_condition("precipitation_mm", 0, 100)),
        expect.row_check("trip_ends_after_start", s, F.col("dropoff_at") <= F.col("pickup_at")),
    ])


register("expect_summary", with_all(f"""
SELECT name, severity, failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM (
  SELECT 'stg_trip_id_not_null' AS name, 'error' AS severity, (SELECT count(*) FROM stg WHERE trip_id IS NULL) AS failures
  UNION ALL SELECT 'stg_trip_id_unique', 'warn',
    (SELECT count(*) FROM (SELECT trip_id FROM stg WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1))
  UNION ALL SELECT 'stg_pickup_hour_in_weather', 'error',
    (SELECT count(*) FROM stg WHERE pickup_hour IS NOT NULL AND pickup_hour NOT IN (SELECT weather_hour FROM weather))
  UNION ALL SELECT 'stg_ratecode_accepted', 'error',
    (SELECT count(*) FROM stg WHERE ratecode_id IS NOT NULL AND ratecode_id NOT IN ({", ".join(str(c) for c, _ in RATE_CODES)}))
  UNION ALL SELECT 'weather_hour_unique', 'error',
    (SELECT count(*) FROM (SELECT weather_hour FROM weather GROUP BY weather_hour HAVING count(*) > 1))
  UNION ALL SELECT 'weather_temperature_range', 'error',
    (SELECT count(*) FROM weather WHERE temperature_c < -30 OR temperature_c > 45)
  UNION ALL SELECT 'weather_precipitation_range', 'error',
    (SELECT count(*) FROM weather WHERE precipitation_mm < 0 OR precipitation_mm > 100)
  UNION ALL SELECT 'trip_ends_after_start', 'error', (SELECT count(*) FROM stg WHERE dropoff_at <= pickup_at))"""))


# ---------------------------------------------------------------- profiling

def _checks(p=P):
    """The quarantine conditions, each counted on its own, and what only a profile looks at."""
    return {name: cond for name, cond in row_checks(p).items() if name != "missing_timestamp"} | {
        "passenger_count_missing": F.col("passenger_count").isNull(),
        "unknown_pickup_zone": F.col("pu_location_id").isin(*UNKNOWN_ZONE_IDS),
    }


CHECK_SQL = {
    "pickup_outside_month": "year(pickup_datetime) <> year OR month(pickup_datetime) <> month",
    "dropoff_before_pickup": "dropoff_datetime < pickup_datetime",
    "negative_amount": "fare_amount < 0 OR total_amount < 0",
    "too_short": f"duration_min < {P.min_duration}",
    "too_long": f"duration_min > {P.max_duration}",
    "too_far": f"trip_distance > {P.max_distance}",
    "zero_distance": "trip_distance = 0",
    "passenger_count_missing": "passenger_count IS NULL",
    "unknown_pickup_zone": f"pu_location_id IN {UNKNOWN_ZONE_IDS}",
}


def _long_sql(names_to_expr: dict, label: str, count: str) -> str:
    parts = [f"SELECT '{n}' AS \"{label}\", count(*) FILTER (WHERE {e}) AS {count}, count(*) AS total_rows FROM profiled"
             for n, e in names_to_expr.items()]
    return ("SELECT total_rows, \"" + label + "\", " + count + ", CASE WHEN total_rows > 0 THEN "
            + rhu(f"CAST({count} AS DOUBLE) / total_rows", 6) + " END AS share FROM (\n"
            + "\nUNION ALL ".join(parts) + ")")


@query("profile_checks")
def q_profile_checks(spark: SparkSession, root: str) -> DataFrame:
    return profile.checks(profiled(spark, root), _checks())


register("profile_checks", with_profiled(_long_sql(CHECK_SQL, "check", "n_rows")))

PROFILE_COLUMNS = [f.target for f in P.contract] + ["year", "month", "duration_min"]


@query("profile_nulls")
def q_profile_nulls(spark: SparkSession, root: str) -> DataFrame:
    return profile.nulls(profiled(spark, root), PROFILE_COLUMNS)


register("profile_nulls", with_profiled(_long_sql({c: f"{c} IS NULL" for c in PROFILE_COLUMNS}, "column", "n_null")))


@query("profile_breakdown")
def q_profile_breakdown(spark: SparkSession, root: str) -> DataFrame:
    return profile.breakdown(profiled(spark, root), "payment_type", {
        "all_rows": F.lit(True),
        "passenger_null": F.col("passenger_count").isNull(),
        "negative_fare": F.col("fare_amount") < 0,
    })


register("profile_breakdown", with_profiled("""
SELECT payment_type, count(*) AS all_rows, count(*) FILTER (WHERE passenger_count IS NULL) AS passenger_null,
       count(*) FILTER (WHERE fare_amount < 0) AS negative_fare
FROM profiled GROUP BY payment_type"""))


@query("profile_summary")
def q_profile_summary(spark: SparkSession, root: str) -> DataFrame:
    """Exact distribution summary (min, 1%, 25%, 50%, 75%, 99%, max) of six columns."""
    columns = materialize(spark, profiled(spark, root).select(*SUMMARY_COLUMNS), "profile-columns")   # read by every pass
    return profile.exact_summary(columns, SUMMARY_COLUMNS, SUMMARY_PROBS)


def _summary_sql() -> str:
    parts = []
    for c in SUMMARY_COLUMNS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS \"column\", 'min' AS stat, min({x}) AS value FROM profiled")
        parts.append(f"SELECT '{c}', 'max', max({x}) FROM profiled")
        for p in SUMMARY_PROBS:
            parts.append(f"""SELECT '{c}', '{p:g}', (SELECT v FROM (
  SELECT {x} AS v, row_number() OVER (ORDER BY {x}) AS rn, count(*) OVER () AS n FROM profiled WHERE {c} IS NOT NULL)
  WHERE rn = greatest(1, CAST(ceil({p!r} * n) AS BIGINT)))""")
    return with_profiled("\nUNION ALL ".join(parts))


register("profile_summary", _summary_sql())


@query("profile_summary_approx")
def q_profile_summary_approx(spark: SparkSession, root: str) -> DataFrame:
    """Whether each statistic of the approximate summary (bounded-memory sketches) is within the
    promised rank error of the exact one."""
    return profile.approx_within(profiled(spark, root), SUMMARY_COLUMNS, SUMMARY_PROBS)


register("profile_summary_approx", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{p}' AS stat, true AS within" for c in SUMMARY_COLUMNS
    for p in ("min", *(f"{p:g}" for p in SUMMARY_PROBS), "max")))


# ---------------------------------------------------------------- small analytic queries

@query("filtered_count")
def q_filtered_count(spark: SparkSession, root: str) -> DataFrame:
    return profile.filtered_count(silver(spark, root), F.col("is_airport_trip"), "airport_trips")


register("filtered_count", with_trips("SELECT count(*) AS airport_trips FROM silver WHERE is_airport_trip"))


@query("topk_groups")
def q_topk_groups(spark: SparkSession, root: str) -> DataFrame:
    return profile.top_groups(silver(spark, root), "pu_location_id", 5, [
        F.count(F.lit(1)).alias("trips"), round_half_up(F.avg("tip_pct"), 1).alias("avg_tip_pct")], "trips")


register("topk_groups", with_trips(f"""
SELECT pu_location_id, count(*) AS trips, {rhu("avg(tip_pct)", 1)} AS avg_tip_pct
FROM silver GROUP BY pu_location_id ORDER BY trips DESC, pu_location_id ASC NULLS FIRST LIMIT 5"""))


@query("distinct_count")
def q_distinct_count(spark: SparkSession, root: str) -> DataFrame:
    return profile.distinct_count(silver(spark, root), "pickup_datetime", "distinct_pickups")


register("distinct_count", with_trips("SELECT count(DISTINCT pickup_datetime) AS distinct_pickups FROM silver"))


@query("distinct_events")
def q_distinct_events(spark: SparkSession, root: str) -> DataFrame:
    """The big-shuffle distinct over the largest time-stamped stream: distinct event instants."""
    return profile.distinct_count(table(spark, root, "events"), "ts", "distinct_ts")


register("distinct_events", "SELECT count(DISTINCT ts) AS distinct_ts FROM events")


# ---------------------------------------------------------------- profiles stored per batch

@query("distinct_by_bitmap")
def q_distinct_by_bitmap(spark: SparkSession, root: str) -> DataFrame:
    """Exact distinct pickups of every year, from bitmaps stored per month and merged: no row is read again."""
    store = scratch_path(spark, "pickup-bitmaps")
    stored = stored_profile.refresh(spark, silver(spark, root), store, ["year", "month"],
                                    lambda rows: stored_profile.bitmap_batches(rows, ["year", "month"], "pickup_datetime"))
    return stored_profile.distinct_from_bitmaps(stored, ["year"], "distinct_pickups")


register("distinct_by_bitmap", with_trips("SELECT year, count(DISTINCT pickup_datetime) AS distinct_pickups FROM silver GROUP BY year"))


@query("profile_stored")
def q_profile_stored(spark: SparkSession, root: str) -> DataFrame:
    """Quantiles of every year from sketches stored per month and merged. Sketches are drawn at random, so each estimate is
    reported by whether its true rank, counted over all rows, is within the promised error of what was asked for."""
    rows = materialize(spark, silver(spark, root).select("year", "month", *SUMMARY_COLUMNS), "profiled-trips")
    stored = stored_profile.refresh(spark, rows, scratch_path(spark, "trip-sketches"), ["year", "month"],
                                    lambda r: stored_profile.sketch_batches(r, ["year", "month"], SUMMARY_COLUMNS))
    merged = stored_profile.merged_quantiles(stored, SUMMARY_PROBS, ["year"])
    return stored_profile.rank_report(rows, merged, SUMMARY_COLUMNS, SUMMARY_PROBS, ["year"])


register("profile_stored", with_trips("\nUNION ALL\n".join(f"""
SELECT year, '{c}' AS "column", count(*) AS n_rows, count({c}) AS n_values, min(CAST({c} AS DOUBLE)) AS least,
       max(CAST({c} AS DOUBLE)) AS greatest, CASE WHEN count({c}) > 0 THEN true END AS within_promise
FROM silver GROUP BY year""" for c in SUMMARY_COLUMNS)))

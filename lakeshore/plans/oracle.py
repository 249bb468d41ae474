"""DuckDB SQL for every registered query: an independent statement of each result over the
same Parquet tables (views region, nation, ..., lineitem, orders, events are registered by
the checker). Shared CTE fragments mirror ``lakeshore.plans.standins`` line by line.

Parity notes: DuckDB ``date_sub('second', a, b)`` truncates like Spark ``timestampdiff``;
double -> int casts are avoided or applied to integral values; money stays DECIMAL(12,2);
sums of DECIMAL(12,2) are cast to DECIMAL(22,2), averages of money to DOUBLE before rounding.
"""
from __future__ import annotations

AIRPORTS = "(1, 13, 24)"


def rhu(expr: str, scale: int) -> str:
    """SQL twin of ``lakeshore.functions.round_half_up``: drop float noise below 1e-9, round."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,9)), {scale}) AS DOUBLE)"

RAW_TRIPS = f"""
raw AS (
  SELECT
    l_suppkey AS VendorID,
    CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE pickup END AS tpep_pickup_datetime,
    CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE pickup + to_seconds(CAST(CASE
        WHEN l_orderkey % 43 = 0 THEN -300 WHEN l_orderkey % 47 = 0 THEN 20 WHEN l_orderkey % 59 = 0 THEN 43200
        ELSE 120 + (l_partkey * 37 + l_linenumber * 11) % 5400 END AS BIGINT)) END AS tpep_dropoff_datetime,
    CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST(l_linenumber - 2 AS DOUBLE) END AS passenger_count,
    CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_orderkey % 83 = 0 THEN CAST(0 AS DOUBLE)
         WHEN l_orderkey % 79 = 0 THEN l_quantity + 150 ELSE l_quantity / 2 END AS trip_distance,
    l_partkey % 7 + 1 AS RatecodeID,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE o_custkey % 25 END AS PULocationID,
    l_suppkey % 25 AS DOLocationID,
    l_partkey % 5 AS payment_type,
    CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE l_extendedprice - 3000 END AS fare_amount,
    l_discount * 10 AS extra,
    l_tax AS mta_tax,
    CASE WHEN l_partkey % 5 = 1 THEN l_discount * 100 ELSE CAST(0 AS DOUBLE) END AS tip_amount,
    l_tax * 10 AS tolls_amount,
    CAST(1 AS DOUBLE) AS improvement_surcharge,
    (l_extendedprice - 2990) + l_discount * 100 AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    CASE WHEN l_suppkey % 25 IN {AIRPORTS} THEN CAST(1.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Airport_fee,
    CAST(year(CAST(o_orderdate AS DATE) - 1) AS INTEGER) AS year,
    CAST(month(CAST(o_orderdate AS DATE) - 1) AS INTEGER) AS month
  FROM (SELECT *, o_orderdate + to_minutes(CAST(l_linenumber * 60 + l_partkey % 60 AS BIGINT)) AS pickup
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
)"""

CONFORMED = """
conformed AS (
  SELECT
    CAST(VendorID AS INTEGER) AS vendor_id,
    CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    CAST(passenger_count AS INTEGER) AS passenger_count,
    CAST(trip_distance AS DOUBLE) AS trip_distance,
    CAST(RatecodeID AS INTEGER) AS ratecode_id,
    store_and_fwd_flag,
    CAST(PULocationID AS INTEGER) AS pu_location_id,
    CAST(DOLocationID AS INTEGER) AS do_location_id,
    CAST(payment_type AS INTEGER) AS payment_type,
    CAST(fare_amount AS DECIMAL(12,2)) AS fare_amount,
    CAST(extra AS DECIMAL(12,2)) AS extra,
    CAST(mta_tax AS DECIMAL(12,2)) AS mta_tax,
    CAST(tip_amount AS DECIMAL(12,2)) AS tip_amount,
    CAST(tolls_amount AS DECIMAL(12,2)) AS tolls_amount,
    CAST(improvement_surcharge AS DECIMAL(12,2)) AS improvement_surcharge,
    CAST(total_amount AS DECIMAL(12,2)) AS total_amount,
    CAST(congestion_surcharge AS DECIMAL(12,2)) AS congestion_surcharge,
    CAST(Airport_fee AS DECIMAL(12,2)) AS airport_fee,
    CAST(0 AS DECIMAL(12,2)) AS cbd_congestion_fee,
    year, month
  FROM raw
)"""

DERIVED = f"""
derived AS (
  SELECT
    vendor_id, pickup_datetime, dropoff_datetime,
    CASE WHEN passenger_count > 0 THEN passenger_count END AS passenger_count,
    trip_distance, ratecode_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    congestion_surcharge, airport_fee, cbd_congestion_fee, year, month,
    {rhu("CAST(date_sub('second', pickup_datetime, dropoff_datetime) AS DOUBLE) / 60.0", 2)} AS duration_min,
    CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(date_trunc('hour', pickup_datetime) AS TIMESTAMP) AS pickup_hour,
    CASE WHEN payment_type = 1 AND fare_amount > 0
         THEN {rhu("CAST(tip_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE) * 100", 2)} END AS tip_pct,
    (pu_location_id IN {AIRPORTS}) OR (do_location_id IN {AIRPORTS}) AS is_airport_trip
  FROM conformed
)"""

CLEAN = """
clean AS (
  SELECT *,
    CASE
      WHEN pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN 'missing_timestamp'
      WHEN year(pickup_datetime) <> year OR month(pickup_datetime) <> month THEN 'pickup_outside_month'
      WHEN dropoff_datetime < pickup_datetime THEN 'dropoff_before_pickup'
      WHEN duration_min < 1 THEN 'too_short'
      WHEN duration_min > 360 THEN 'too_long'
      WHEN fare_amount < 0 OR total_amount < 0 THEN 'negative_amount'
      WHEN trip_distance > 100 THEN 'too_far'
    END AS reject_reason
  FROM derived
)"""

SILVER = """
silver AS (SELECT * EXCLUDE (reject_reason) FROM clean WHERE reject_reason IS NULL)"""

TRIP_CTES = ",".join([RAW_TRIPS, CONFORMED, DERIVED, CLEAN, SILVER])


STG_SQL = """
stg AS (
  SELECT
    md5(concat_ws('-',
        coalesce(CAST(vendor_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
        coalesce(CAST(pickup_datetime AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
        coalesce(CAST(dropoff_datetime AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
        coalesce(CAST(pu_location_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
        coalesce(CAST(do_location_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
        coalesce(CAST(total_amount AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS trip_id,
    pickup_datetime AS pickup_at, dropoff_datetime AS dropoff_at, pickup_date, pickup_hour, duration_min,
    pu_location_id AS pickup_location_id, do_location_id AS dropoff_location_id, is_airport_trip,
    vendor_id, passenger_count, trip_distance AS trip_distance_miles, ratecode_id,
    store_and_fwd_flag = 'Y' AS is_store_and_forward, payment_type, fare_amount, extra AS extra_amount,
    mta_tax, tip_amount, tip_pct, tolls_amount, improvement_surcharge, congestion_surcharge,
    airport_fee, cbd_congestion_fee, total_amount,
    CAST(make_date(year, month, 1) + INTERVAL 1 MONTH AS TIMESTAMP) + INTERVAL 78 HOUR AS loaded_at
  FROM silver
)"""


def with_trips(body: str, *extra_ctes: str) -> str:
    """``WITH`` the trip CTEs (raw .. silver) plus ``extra_ctes``, then ``body``."""
    ctes = ",".join([TRIP_CTES, *extra_ctes])
    return f"WITH {ctes}\n{body}"


LOCAL_ZONE = "America/New_York"

# ---- DuckDB statements of the stand-in documents, exploded (one row per UTC hour)
WEATHER_CTES = f"""
months AS (
  SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, CAST(m AS DATE) AS month_start
  FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                      date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m
        FROM orders)
),
utc AS (
  SELECT year, month, utc_time, CAST(floor(epoch(utc_time) / 3600) AS BIGINT) + coalesce(load, 0) AS n
  FROM (SELECT year, month,
               unnest(generate_series(CAST(month_start AS TIMESTAMP),
                                      CAST(month_start + INTERVAL 1 MONTH AS TIMESTAMP) + INTERVAL 23 HOUR,
                                      INTERVAL 1 HOUR)) AS utc_time
        FROM months)
  LEFT JOIN (SELECT (day(ts) - 1) * 24 + hour(ts) AS slot,
                    CAST(count(*) * 7 + coalesce(sum(CAST(round(value * 100) AS BIGINT)), 0) AS BIGINT) AS load
             FROM events GROUP BY 1) ON slot = (day(utc_time) - 1) * 24 + hour(utc_time)
),
m1 AS (
  SELECT year, month, utc_time, n,
         round(((n * 37) % 400) / CAST(10 AS DOUBLE) - 10.0, 1) AS temperature_c,
         ((n * 13) % 70) / CAST(10 AS DOUBLE) - 2.0 AS wet,
         round(((n * 17) % 300) / CAST(10 AS DOUBLE), 1) AS wind_speed_kmh
  FROM utc
),
m2 AS (
  SELECT *, CASE WHEN n % 11 = 0 THEN NULL WHEN wet > 0 THEN round(wet, 1) ELSE CAST(0 AS DOUBLE) END AS precipitation_mm
  FROM m1
),
m3 AS (
  SELECT *,
    CASE WHEN temperature_c < 0 AND precipitation_mm > 0 THEN round(precipitation_mm * 0.7, 2) ELSE CAST(0 AS DOUBLE) END AS snowfall_cm,
    CASE WHEN temperature_c >= 0 THEN precipitation_mm ELSE CAST(0 AS DOUBLE) END AS rain_mm
  FROM m2
),
wx_utc AS (
  SELECT year, month, utc_time, temperature_c, precipitation_mm, rain_mm, snowfall_cm, wind_speed_kmh,
    CAST(CASE WHEN snowfall_cm > 0 THEN 71 WHEN precipitation_mm > 2.5 THEN 63
              WHEN precipitation_mm > 0 THEN 61 ELSE n % 4 END AS INTEGER) AS weather_code
  FROM m3
),
wx_local AS (
  SELECT year, month, timezone('{LOCAL_ZONE}', timezone('UTC', utc_time)) AS weather_hour,
         temperature_c, precipitation_mm, rain_mm, snowfall_cm, wind_speed_kmh, weather_code
  FROM wx_utc
),
wx_own AS (
  SELECT * FROM wx_local WHERE year(weather_hour) = year AND month(weather_hour) = month
),
weather AS (
  SELECT year, month, weather_hour,
    {rhu("avg(temperature_c)", 1)} AS temperature_c,
    {rhu("sum(precipitation_mm)", 1)} AS precipitation_mm,
    {rhu("sum(rain_mm)", 1)} AS rain_mm,
    {rhu("sum(snowfall_cm)", 2)} AS snowfall_cm,
    {rhu("avg(wind_speed_kmh)", 1)} AS wind_speed_kmh,
    max(weather_code) AS weather_code,
    CAST(weather_hour AS DATE) AS weather_date
  FROM wx_own GROUP BY year, month, weather_hour
)"""


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _lookup_ctes() -> str:
    from lakeshore.sources.lookups import PAYMENT_TYPES, RATE_CODES, WEATHER_CODES
    return f"""
weather_codes(weather_code, weather_description, weather_category) AS (VALUES
    {_values(WEATHER_CODES)}),
payment_types(payment_type, payment_type_name) AS (VALUES
    {_values(PAYMENT_TYPES)}),
rate_codes(ratecode_id, ratecode_name) AS (VALUES
    {_values(RATE_CODES)}),
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
         'Zone ' || CAST(n_regionkey AS VARCHAR) AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""


LOOKUP_CTES = _lookup_ctes()

HOLIDAY_CTES = """
daily_orders AS (
  SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders, sum(o_totalprice) AS value,
         list_sort(list_distinct(list('US-' || o_orderstatus))) AS codes
  FROM orders GROUP BY 1),
ranked_days AS (
  SELECT *, strftime(day, '%Y-%m') AS ym,
    row_number() OVER (PARTITION BY strftime(day, '%Y-%m') ORDER BY n_orders DESC, day) AS r_busy,
    row_number() OVER (PARTITION BY strftime(day, '%Y-%m') ORDER BY value DESC, day) AS r_value,
    row_number() OVER (PARTITION BY strftime(day, '%Y-%m') ORDER BY n_orders, day) AS r_quiet
  FROM daily_orders),
holiday_records AS (
  SELECT strftime(day, '%Y-%m-%d') AS date, 'Busy Day' AS name, 'Busy Day ' || ym AS localName,
         true AS global, CAST(NULL AS VARCHAR[]) AS counties, ['Public'] AS types
  FROM ranked_days WHERE r_busy = 1
  UNION ALL
  SELECT strftime(day, '%Y-%m-%d'), 'Value Day', 'Value Day ' || ym, false, codes, ['Observance', 'Optional']
  FROM ranked_days WHERE r_value = 1
  UNION ALL
  SELECT strftime(day, '%Y-%m-%d'), 'Quiet Day', CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN),
         CAST(NULL AS VARCHAR[]), CAST(NULL AS VARCHAR[])
  FROM ranked_days WHERE r_quiet = 1),
stg_holidays AS (
  SELECT CAST(date AS DATE) AS holiday_date, name AS holiday_name, localName AS holiday_local_name,
         global AS is_nationwide,
         CASE WHEN counties IS NOT NULL THEN array_to_string(counties, ',') END AS observed_in,
         CASE WHEN types IS NOT NULL THEN array_to_string(types, ',') END AS holiday_types
  FROM holiday_records),
holidays_region AS (
  SELECT holiday_date, string_agg(holiday_name, ' / ' ORDER BY holiday_name) AS holiday_name,
         bool_or(is_nationwide) AS is_nationwide
  FROM stg_holidays WHERE is_nationwide OR observed_in LIKE '%US-P%'
  GROUP BY holiday_date)"""

ENRICHED_CTE = """
wx_coded AS (
  SELECT w.weather_hour, w.weather_date, w.temperature_c, w.precipitation_mm, w.rain_mm, w.snowfall_cm,
         w.wind_speed_kmh, w.weather_code, c.weather_description, c.weather_category
  FROM weather w LEFT JOIN weather_codes c ON c.weather_code = w.weather_code),
enriched AS (
  SELECT t.*,
    CAST(hour(t.pickup_at) AS INTEGER) AS pickup_hour_of_day,
    CAST(isodow(t.pickup_at) AS INTEGER) AS pickup_day_of_week,
    isodow(t.pickup_at) IN (6, 7) AS is_weekend,
    h.holiday_date IS NOT NULL AS is_holiday,
    h.holiday_name,
    w.temperature_c, w.precipitation_mm, w.rain_mm, w.snowfall_cm, w.wind_speed_kmh, w.weather_code,
    w.weather_description, w.weather_category,
    pz.borough AS pickup_borough, pz.zone AS pickup_zone,
    dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
    p.payment_type_name, r.ratecode_name
  FROM stg t
  LEFT JOIN wx_coded w ON w.weather_hour = t.pickup_hour
  LEFT JOIN zones pz ON pz.location_id = t.pickup_location_id
  LEFT JOIN zones dz ON dz.location_id = t.dropoff_location_id
  LEFT JOIN payment_types p ON p.payment_type = t.payment_type
  LEFT JOIN rate_codes r ON r.ratecode_id = t.ratecode_id
  LEFT JOIN holidays_region h ON h.holiday_date = t.pickup_date)"""

FCT_CTE = """
fct AS (
  SELECT trip_id, pickup_date AS date_key, pickup_location_id AS pickup_zone_id,
    dropoff_location_id AS dropoff_zone_id, pickup_at, dropoff_at, pickup_hour, pickup_hour_of_day,
    is_weekend, is_holiday, duration_min, trip_distance_miles, passenger_count, is_airport_trip,
    payment_type_name, ratecode_name, fare_amount, tip_amount, tip_pct, total_amount, temperature_c,
    precipitation_mm, snowfall_cm, wind_speed_kmh, weather_category,
    strftime(pickup_at, '%Y-%m') AS source_month, loaded_at
  FROM enriched)"""

DIM_DATE_CTE = f"""
spine AS (
  SELECT CAST(unnest(generate_series(min(pickup_date), max(pickup_date), INTERVAL 1 DAY)) AS DATE) AS date_day
  FROM enriched),
daily_weather AS (
  SELECT weather_date, {rhu("avg(temperature_c)", 1)} AS avg_temperature_c,
         {rhu("sum(precipitation_mm)", 1)} AS total_precipitation_mm,
         {rhu("sum(snowfall_cm)", 1)} AS total_snowfall_cm
  FROM weather GROUP BY weather_date),
dim_date AS (
  SELECT s.date_day AS date_key,
    CAST(year(s.date_day) AS INTEGER) AS year, CAST(month(s.date_day) AS INTEGER) AS month,
    CAST(day(s.date_day) AS INTEGER) AS day_of_month, CAST(isodow(s.date_day) AS INTEGER) AS day_of_week,
    dayname(s.date_day) AS day_name, monthname(s.date_day) AS month_name,
    CAST(quarter(s.date_day) AS INTEGER) AS quarter, CAST(weekofyear(s.date_day) AS INTEGER) AS iso_week,
    isodow(s.date_day) IN (6, 7) AS is_weekend,
    h.holiday_name, h.holiday_date IS NOT NULL AS is_holiday,
    d.avg_temperature_c, d.total_precipitation_mm, d.total_snowfall_cm
  FROM spine s
  LEFT JOIN holidays_region h ON h.holiday_date = s.date_day
  LEFT JOIN daily_weather d ON d.weather_date = s.date_day)"""

MART_CTE = f"""
by_hour AS (
  SELECT pickup_hour, count(*) AS trips, CAST(sum(passenger_count) AS BIGINT) AS passengers,
    {rhu("avg(duration_min)", 2)} AS avg_duration_min,
    {rhu("avg(trip_distance_miles)", 2)} AS avg_distance_miles,
    {rhu("avg(CAST(total_amount AS DOUBLE))", 2)} AS avg_total_amount,
    {rhu("avg(tip_pct)", 2)} AS avg_tip_pct,
    count(*) FILTER (WHERE is_airport_trip) AS airport_trips
  FROM fct GROUP BY pickup_hour),
mart AS (
  SELECT w.weather_hour AS hour_key, w.weather_date AS date_key,
    CAST(hour(w.weather_hour) AS INTEGER) AS hour_of_day,
    d.day_of_week, d.is_weekend, d.is_holiday,
    coalesce(b.trips, 0) AS trips, b.passengers, b.avg_duration_min, b.avg_distance_miles,
    b.avg_total_amount, b.avg_tip_pct, coalesce(b.airport_trips, 0) AS airport_trips,
    w.temperature_c, w.precipitation_mm, w.rain_mm, w.snowfall_cm, w.wind_speed_kmh, w.weather_category,
    CASE WHEN w.snowfall_cm > 0 THEN 'snow' WHEN w.precipitation_mm IS NULL THEN 'unknown'
         WHEN w.precipitation_mm = 0 THEN 'dry' WHEN w.precipitation_mm <= 2.5 THEN 'light rain'
         ELSE 'heavy rain' END AS weather_label
  FROM wx_coded w
  LEFT JOIN by_hour b ON b.pickup_hour = w.weather_hour
  LEFT JOIN dim_date d ON d.date_key = w.weather_date)"""


def with_all(body: str, *extra: str) -> str:
    """Trips, staging, weather, lookups and holidays, plus ``extra`` CTEs, then ``body``."""
    ctes = [TRIP_CTES, STG_SQL, WEATHER_CTES, LOOKUP_CTES, HOLIDAY_CTES, *extra]
    return "WITH " + ",".join(ctes) + "\n" + body

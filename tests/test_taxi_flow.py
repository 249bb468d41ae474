"""The documented real-data path with the taxi defaults: raw monthly trip files (one without
the congestion-fee column) -> published silver + quarantine -> weather documents -> gold."""
import datetime as dt

from pyspark.sql import functions as F

from lakeshore.operators import dims
from lakeshore.plans import warehouse
from lakeshore.plans.pipelines import batch_loaded_at, build_gold, publish_clean, publish_series, read_clean, stage_trips
from lakeshore.plans.trips import TAXI
from lakeshore.session import scratch_path
from lakeshore.sources import batches

D = dt.datetime
RAW = ("VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
       "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
       "PULocationID int, DOLocationID int, payment_type bigint, fare_amount double, extra double, "
       "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
       "total_amount double, congestion_surcharge double, Airport_fee double")


def trip(pickup, minutes, pu=4, do=5, pay=1, fare=10.0, tip=2.0, distance=2.0):
    return (2, pickup, pickup + dt.timedelta(minutes=minutes), 1.0, distance, 1.0, "N", pu, do, pay,
            fare, 0.5, 0.5, tip, 0.0, 1.0, fare + tip + 2.0, 2.5, 0.0)


def weather_doc(year, month):
    start = D(year, month, 1)
    n = ((D(year + (month == 12), month % 12 + 1, 1) - start).days + 1) * 24
    hourly = {"time": [(start + dt.timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(n)],
              "temperature_2m": [5.0] * n, "precipitation": [0.0 if i % 5 else 1.2 for i in range(n)],
              "rain": [0.0] * n, "snowfall": [0.0] * n, "wind_speed_10m": [10.0] * n, "weather_code": [3] * n}
    return (year, month, "GMT", hourly)


DOC = ("year int, month int, timezone string, hourly struct<time: array<string>, temperature_2m: array<double>, "
       "precipitation: array<double>, rain: array<double>, snowfall: array<double>, wind_speed_10m: array<double>, "
       "weather_code: array<int>>")


def test_monthly_flow_with_taxi_defaults(spark):
    lake = scratch_path(spark, "taxi-bronze")
    jan = [trip(D(2025, 1, 10, 8, 5), 15, pu=132), trip(D(2025, 1, 10, 8, 40), 0.5),          # airport; too short
           trip(D(2025, 1, 11, 9, 0), 30, fare=-3.0), trip(D(2024, 12, 31, 23, 50), 20)]     # negative; outside month
    feb = [trip(D(2025, 2, 3, 17, 0), 25, pay=2, tip=0.0), trip(D(2025, 2, 3, 17, 30), 400)]  # cash; too long
    spark.createDataFrame(jan, RAW).write.parquet(f"{lake}/year=2025/month=1")
    spark.createDataFrame(feb, RAW).withColumn("cbd_congestion_fee", F.lit(0.75)) \
        .write.parquet(f"{lake}/year=2025/month=2")
    # the January file lacks cbd_congestion_fee: files are read per footer schema and conformed
    # per group, so January gets the contract's default (0.00), not the null a merged read gives
    folders = {f.split(lake, 1)[1].strip("/"): f for f in batches.leaf_folders(spark, lake)}
    rows_in = batches.read_batches(spark, folders, TAXI.contract, base_path=lake, keep=["year", "month"]).drop("period")
    root = scratch_path(spark, "taxi-silver")
    report = {(r.year, r.month): (r.accepted_rows, r.quarantined_rows)
              for r in publish_clean(spark, rows_in, root, TAXI, conformed=True).collect()}
    assert report == {(2025, 1): (1, 3), (2025, 2): (1, 1)}
    silver = read_clean(spark, root, TAXI, "accepted").drop("reject_reason")
    rows = {r.month: r for r in silver.collect()}
    assert rows[1].is_airport_trip and rows[1].tip_pct == 20.0 and rows[1].duration_min == 15.0
    assert rows[2].tip_pct is None and float(rows[2].cbd_congestion_fee) == 0.75
    assert float(rows[1].cbd_congestion_fee) == 0.0                    # default for the older file
    reasons = sorted(r.reject_reason for r in read_clean(spark, root, TAXI, "quarantined").collect())
    assert reasons == ["negative_amount", "pickup_outside_month", "too_long", "too_short"]

    docs = spark.createDataFrame([weather_doc(2025, 1), weather_doc(2025, 2)], DOC)
    weather_root = scratch_path(spark, "taxi-weather")
    completeness = publish_series(spark, docs, "America/New_York", weather_root)
    assert completeness.filter("complete").count() == 2
    weather = spark.read.parquet(weather_root)
    zones = spark.createDataFrame([(4, "Manhattan", "Alphabet City", "Yellow Zone"), (5, "Staten Island", "Arden Heights", "Boro Zone"),
                                   (132, "Queens", "JFK Airport", "Airports"), (265, "N/A", "Outside of NYC", "N/A")],
                                  "location_id int, borough string, zone string, service_zone string")
    holidays = dims.holidays_for(warehouse.stage_holidays(spark.createDataFrame(
        [("2025-01-01", "New Year's Day", "New Year's Day", True, None, ["Public"])],
        "date string, name string, localName string, global boolean, counties array<string>, types array<string>")),
        "US-NY")
    gold = build_gold(spark, stage_trips(silver, batch_loaded_at()), weather, holidays, zones,
                      scratch_path(spark, "taxi-gold"), full_refresh=True)
    fact = spark.read.parquet(gold["fct_trips"])
    assert sorted(str(r.source_month) for r in fact.collect()) == ["2025-01", "2025-02"]
    assert {r.payment_type_name for r in fact.collect()} == {"Credit card", "Cash"}
    mart = spark.read.parquet(gold["agg_hourly_demand"])
    assert mart.count() == 31 * 24 + 28 * 24 and mart.agg(F.sum("trips")).first()[0] == 2
    zone_dim = {r.zone_id: (r.is_airport, r.is_unknown) for r in spark.read.parquet(gold["dim_zone"]).collect()}
    assert zone_dim[132] == (True, False) and zone_dim[265] == (False, True)

"""Queries of the bronze -> silver trip cleaning (contract, derivations, quarantine)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions import month_key, surrogate_key
from lakeshore.operators.contract import conform
from lakeshore.operators.rules import quarantined, reason_histogram, split
from lakeshore.plans import standins
from lakeshore.plans.catalog import query
from lakeshore.plans.oracle import STG_SQL, register, with_trips
from lakeshore.plans.pipelines import TRIP_KEY_COLUMNS, batch_loaded_at, publish_clean, stage_trips
from lakeshore.plans.trips import clean_trips, derive_trip
from lakeshore.session import require_utc, scratch_path
from lakeshore.sources import batches

P = standins.STANDIN_TRIPS


def cleaned(spark: SparkSession, root: str, by_batch: bool = False) -> DataFrame:
    require_utc(spark)
    return clean_trips(standins.raw_trips(spark, root, by_batch), P)


def silver(spark: SparkSession, root: str) -> DataFrame:
    return split(cleaned(spark, root))[0]


def silver_lake(spark: SparkSession, root: str) -> DataFrame:
    """Silver stored by batch and read back, for queries that build on it more than once: the trips are joined and
    shuffled once, and whatever is computed row by row from a file lies in that file's batch."""
    path = scratch_path(spark, "silver-lake")
    rows = split(cleaned(spark, root, by_batch=True))[0]
    batches.write_batches(rows, path, P.batch_cols, files_per_batch=0)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def staged(spark: SparkSession, root: str, trips: DataFrame | None = None) -> DataFrame:
    return stage_trips(silver(spark, root) if trips is None else trips, batch_loaded_at())


@query("conform")
def q_conform(spark: SparkSession, root: str) -> DataFrame:
    return conform(standins.raw_trips(spark, root), P.contract, keep=["year", "month"])


register("conform", with_trips("SELECT * FROM conformed"))


@query("derive_trip")
def q_derive_trip(spark: SparkSession, root: str) -> DataFrame:
    c = conform(standins.raw_trips(spark, root), P.contract, keep=["year", "month"])
    return derive_trip(c, P).select(
        "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "duration_min",
        "pickup_date", "pickup_hour", "tip_pct", "is_airport_trip", "pu_location_id", "do_location_id")


register("derive_trip", with_trips("""
SELECT vendor_id, pickup_datetime, dropoff_datetime, passenger_count, duration_min,
       pickup_date, pickup_hour, tip_pct, is_airport_trip, pu_location_id, do_location_id
FROM derived"""))


@query("reject_reason")
def q_reject_reason(spark: SparkSession, root: str) -> DataFrame:
    return cleaned(spark, root).select(
        "vendor_id", "pickup_datetime", "dropoff_datetime", "duration_min", "fare_amount",
        "total_amount", "trip_distance", "year", "month", "reject_reason")


register("reject_reason", with_trips("""
SELECT vendor_id, pickup_datetime, dropoff_datetime, duration_min, fare_amount,
       total_amount, trip_distance, year, month, reject_reason
FROM clean"""))


@query("split_accept")
def q_split_accept(spark: SparkSession, root: str) -> DataFrame:
    return silver(spark, root)


register("split_accept", with_trips("SELECT * FROM silver"))


@query("split_quarantine")
def q_split_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return quarantined(cleaned(spark, root))


register("split_quarantine", with_trips("SELECT * FROM clean WHERE reject_reason IS NOT NULL"))


@query("reject_histogram")
def q_reject_histogram(spark: SparkSession, root: str) -> DataFrame:
    return reason_histogram(cleaned(spark, root))


register("reject_histogram", with_trips("""
SELECT reject_reason, count(*) AS n_rows FROM clean
WHERE reject_reason IS NOT NULL GROUP BY reject_reason ORDER BY n_rows DESC, reject_reason"""))


@query("reconcile_split")
def q_reconcile_split(spark: SparkSession, root: str) -> DataFrame:
    """Landed rows per batch against the two layers as they lie on disk."""
    require_utc(spark)
    raw = standins.raw_trips(spark, root, by_batch=True)
    return publish_clean(spark, raw, scratch_path(spark, "reconcile"), P, files_per_batch=0)


register("reconcile_split", with_trips("""
SELECT year, month, count(*) AS input_rows,
       count(*) FILTER (WHERE reject_reason IS NULL) AS accepted_rows,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS quarantined_rows,
       count(*) = count(*) FILTER (WHERE reject_reason IS NULL)
                + count(*) FILTER (WHERE reject_reason IS NOT NULL) AS reconciled
FROM clean GROUP BY year, month"""))


def with_stg(body: str) -> str:
    return with_trips(body, STG_SQL)


@query("stage_rename")
def q_stage_rename(spark: SparkSession, root: str) -> DataFrame:
    return staged(spark, root)


register("stage_rename", with_stg("SELECT * FROM stg"))


@query("surrogate_key")
def q_surrogate_key(spark: SparkSession, root: str) -> DataFrame:
    s = silver(spark, root)
    return s.select(surrogate_key(*TRIP_KEY_COLUMNS).alias("trip_id"), *TRIP_KEY_COLUMNS)


register("surrogate_key", with_stg("""
SELECT trip_id, vendor_id, pickup_at AS pickup_datetime, dropoff_at AS dropoff_datetime,
       pickup_location_id AS pu_location_id, dropoff_location_id AS do_location_id, total_amount
FROM stg"""))


@query("month_key")
def q_month_key(spark: SparkSession, root: str) -> DataFrame:
    return (staged(spark, root).groupBy(month_key("pickup_at").alias("source_month"))
            .agg(F.count("*").alias("n_trips")))


register("month_key", with_stg("""
SELECT strftime(pickup_at, '%Y-%m') AS source_month, count(*) AS n_trips FROM stg GROUP BY 1"""))

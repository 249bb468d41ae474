"""Composed plans of the trip pipeline, for many batches at once.

stage      silver -> staging names, surrogate key, loaded_at
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions import surrogate_key
from lakeshore.plans.trips import TAXI, TripParams, clean_trips

TRIP_KEY_COLUMNS = ("vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id",
                    "do_location_id", "total_amount")


def batch_loaded_at(year: str = "year", month: str = "month", hours_after: int = 78) -> Column:
    """Deterministic load instant of a batch: ``hours_after`` hours into the next month."""
    start = F.make_date(F.col(year), F.col(month), F.lit(1))
    return F.timestamp_add("HOUR", F.lit(hours_after), F.add_months(start, 1).cast("timestamp_ntz"))


def stage_trips(silver: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Staging projection: readable names, a surrogate trip id, the load instant."""
    loaded = loaded_at if loaded_at is not None else F.col("loaded_at")
    return silver.select(
        surrogate_key(*TRIP_KEY_COLUMNS).alias("trip_id"),
        F.col("pickup_datetime").alias("pickup_at"),
        F.col("dropoff_datetime").alias("dropoff_at"),
        "pickup_date", "pickup_hour", "duration_min",
        F.col("pu_location_id").alias("pickup_location_id"),
        F.col("do_location_id").alias("dropoff_location_id"),
        "is_airport_trip", "vendor_id", "passenger_count",
        F.col("trip_distance").alias("trip_distance_miles"),
        "ratecode_id",
        (F.col("store_and_fwd_flag") == "Y").alias("is_store_and_forward"),
        "payment_type", "fare_amount",
        F.col("extra").alias("extra_amount"),
        "mta_tax", "tip_amount", "tip_pct", "tolls_amount", "improvement_surcharge",
        "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
        loaded.alias("loaded_at"),
    )


LAYER_COL = "layer"


def clean_schema(spark, p: TripParams = TAXI):
    """Columns and types of the published layers."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    from lakeshore.plans.trips import clean_conformed

    typed = [StructType.fromDDL(f"`{f.target}` {f.dtype}").fields[0] if isinstance(f.dtype, str) else StructField(f.target, f.dtype)
             for f in p.contract]
    empty = spark.createDataFrame([], StructType([*typed, *[StructField(c, IntegerType()) for c in p.batch_cols]]))
    return clean_conformed(empty, p).withColumn(LAYER_COL, F.lit("")).schema


def read_clean(spark, root: str, p: TripParams = TAXI, layer: str | None = None) -> DataFrame:
    """What :func:`publish_clean` has published: both layers, or one of them."""
    from lakeshore.sources import versions

    rows = versions.read(spark, root, clean_schema(spark, p), p.batch_cols)
    return rows if layer is None else rows.filter(F.col(LAYER_COL) == layer).drop(LAYER_COL)


def publish_clean(spark, raw: DataFrame, root: str, p: TripParams = TAXI, conformed: bool = False,
                  expected: dict[tuple, int] | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Clean many raw batches and publish accepted and quarantined rows, replacing both layers of exactly the batches
    present, at one commit point per batch (:mod:`lakeshore.sources.versions`; read with :func:`read_clean`).

    The input is read and cleaned once, in the write, which also observes it: rows read, accepted and
    quarantined. They must equal each other and what the footers of the written files say, per batch also
    ``expected``, where the source reports it (or the counts of the written batches, if it does not). Tasks that ran twice after a lost
    executor are observed twice, so a difference that could come from that is settled by counting the input anew.
    Nothing of a publication that does not reconcile is seen. Returns the reconciliation per batch: input rows,
    and the layers as the files on disk hold them. ``conformed=True`` takes rows already conformed to the contract
    (``read_batches``); ``files_per_batch`` is :func:`lakeshore.sources.batches.spread`'s (0 for input that lies by batch)."""
    from pyspark.sql import Observation

    from lakeshore.operators.rules import ReconcileError
    from lakeshore.plans.trips import clean_conformed
    from lakeshore.sources import versions
    from lakeshore.sources.batches import batch_counts

    batch = list(p.batch_cols)
    read_, split_ = Observation(f"{LAYER_COL} input"), Observation(f"{LAYER_COL} split")
    seen = raw.observe(read_, F.count(F.lit(1)).alias("rows"))
    cleaned = clean_conformed(seen, p) if conformed else clean_trips(seen, p)
    reason = F.col("reject_reason")
    layered = cleaned.withColumn(LAYER_COL, F.when(reason.isNull(), "accepted").otherwise("quarantined")).observe(
        split_, F.count_if(reason.isNull()).alias("accepted"), F.count_if(reason.isNotNull()).alias("quarantined"))

    def wanted(written: dict[tuple, int]) -> dict[tuple, int]:
        rows, layers, total = read_.get["rows"], split_.get, sum(written.values())
        if expected is not None:
            return dict(expected)
        if rows == layers["accepted"] + layers["quarantined"] == total:
            return written
        counted = batch_counts(raw, batch)
        if sum(counted.values()) != total:
            raise ReconcileError(f"{root}: not published; {sum(counted.values())} rows read, {total} written")
        return counted

    found = versions.publish(spark, layered, root, batch, wanted, [LAYER_COL], files_per_batch)
    held: dict[tuple, dict[str, int]] = {k: {} for k in (expected or {})}
    for key, n in found.items():
        held.setdefault(key[:-1], {})[key[-1]] = n
    rows = [(*k, (expected or {}).get(k, sum(v.values())), v.get("accepted", 0), v.get("quarantined", 0)) for k, v in held.items()]
    schema = layered.select(*batch).schema.add("input_rows", "long").add("accepted_rows", "long").add("quarantined_rows", "long")
    return spark.createDataFrame(rows, schema).withColumn(
        "reconciled", F.col("input_rows") == F.col("accepted_rows") + F.col("quarantined_rows"))


def publish_series(spark, docs: DataFrame, zone: str, root: str, batch_cols=("year", "month"),
                   tolerance: int = 1) -> DataFrame:
    """Documents of many months -> silver hourly series in ``root`` (one folder per batch,
    one file per month, rows ordered by hour), then checked from what is on disk: hours per
    month within ``tolerance`` of the calendar and no hour without temperature. Returns the
    per-month completeness report; raises when a month fails."""
    from lakeshore.operators.rules import ReconcileError
    from lakeshore.operators.series import flatten_series, month_completeness
    from lakeshore.sources.batches import write_batches

    write_batches(flatten_series(docs, zone, keep=batch_cols), root, batch_cols, files_per_batch=1,
                  sort_by=("weather_hour",))
    report = month_completeness(spark.read.parquet(root), zone)
    bad = report.filter(~F.col("within_tolerance") | (F.col("null_required_hours") > 0)).limit(5).collect()
    if bad:
        raise ReconcileError(f"{root}: incomplete months {[tuple(r) for r in bad]}")
    return report


def build_gold(spark, stg_trips: DataFrame, weather: DataFrame, holidays_region: DataFrame, zones: DataFrame,
               gold_root: str, months=None, full_refresh: bool = False, airport_ids=(1, 132, 138),
               unknown_boroughs=("Unknown", "N/A"), extra_sources=()) -> dict[str, str]:
    """The gold build: dimensions, the incremental fact and the hourly mart, written under
    ``gold_root``. The fact is rebuilt in full, for the named ``months``, or for the months
    with rows newer than its high-water mark; the mart is recomputed from the stored fact.
    The weather hours (with code names), region holidays and zones are stored as gold
    dimensions first and the fact is enriched against those stored tables. ``extra_sources``
    (``source_month``, ``loaded_at``) trigger the months of late reloads of other inputs."""
    from lakeshore.operators import dims
    from lakeshore.operators.incremental import build_incremental
    from lakeshore.plans import warehouse

    from concurrent.futures import ThreadPoolExecutor

    from lakeshore.sources import lookups

    paths = {name: f"{gold_root.rstrip('/')}/{name}" for name in (
        "dim_zone", "dim_weather_hour", "dim_holiday", "dim_date", "fct_trips", "agg_hourly_demand")}
    # the small dimensions are stored first (concurrently): the fact is enriched against stored
    # tables, whose measured size is what the planner's broadcast decision uses
    small = {"dim_zone": dims.zone_dim(zones, airport_ids, unknown_boroughs),
             "dim_weather_hour": warehouse.weather_with_codes(weather, lookups.weather_codes(spark)),
             "dim_holiday": holidays_region}
    with ThreadPoolExecutor(max_workers=len(small)) as pool:
        for f in [pool.submit(lambda n, df: df.write.mode("overwrite").parquet(paths[n]), n, df)
                  for n, df in small.items()]:
            f.result()
    weather = spark.read.parquet(paths["dim_weather_hour"])
    holidays_region = spark.read.parquet(paths["dim_holiday"])
    enriched = warehouse.enrich_trips(spark, stg_trips, weather, zones, holidays_region)
    facts = warehouse.fact_trips(enriched)
    build_incremental(spark, facts, paths["fct_trips"], months=months, full_refresh=full_refresh,
                      extra_sources=extra_sources)
    # the fact's columns are known: which file's footer is read first must not decide them
    fact = spark.read.schema(facts.schema).parquet(paths["fct_trips"])
    warehouse.dim_date(fact.select(F.col("date_key").alias("pickup_date")), holidays_region, weather) \
        .write.mode("overwrite").parquet(paths["dim_date"])
    warehouse.hourly_mart(spark, fact, weather, holidays_region).write.mode("overwrite").parquet(
        paths["agg_hourly_demand"])
    return paths

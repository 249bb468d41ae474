"""Queries of the batch lake: partitioned scans, batch replace, incremental fact builds,
schema drift across batch files, file manifests and type-2 history.

These queries write to folders under the shared scratch area (``spark.checkpoint.dir``)
and read them back, as the pipeline does between its layers."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.functions import month_key
from lakeshore.operators import history, incremental
from lakeshore.operators.contract import Field, schema_drift
from lakeshore.operators.rules import split
from lakeshore.plans import standins
from lakeshore.plans.catalog import query
from lakeshore.plans.oracle import ENRICHED_CTE, FCT_CTE, register, with_all, with_trips
from lakeshore.plans.q_clean import silver_lake, staged
from lakeshore.plans.q_marts import fact
from lakeshore.plans.trips import clean_trips
from lakeshore.session import materialize, require_utc, scratch_path
from lakeshore.sources import batches
from lakeshore.sources.tables import table

SCAN_YEAR, SCAN_MONTH = 1997, 5
REBUILD_MONTHS = ["1997-05", "1999-12", "1990-01"]     # the last one has no rows: a no-op
RELOAD_SHIFT_DAYS = 30
HWM_BEFORE = "2001-06"                                   # target built before this month
APPEND_MONTHS = ["2001-07", "2001-08"]
MANIFEST_SPLIT_YEAR = 2001


def bronze_lake(spark: SparkSession, root: str) -> str:
    """Raw trips landed as batch folders year=/month= (the bronze layer)."""
    path = scratch_path(spark, "bronze-trips")
    batches.write_batches(standins.raw_trips(spark, root, by_batch=True), path, ["year", "month"], files_per_batch=0)
    return path


def accepted_trips(bronze: DataFrame) -> DataFrame:
    """Silver of bronze batches."""
    require_utc(bronze.sparkSession)
    return split(clean_trips(bronze, standins.STANDIN_TRIPS))[0]


@query("scan_month")
def q_scan_month(spark: SparkSession, root: str) -> DataFrame:
    return batches.read_leaf(spark, bronze_lake(spark, root), year=SCAN_YEAR, month=f"{SCAN_MONTH}")


register("scan_month", with_trips(f"SELECT * EXCLUDE (year, month) FROM raw WHERE year = {SCAN_YEAR} AND month = {SCAN_MONTH}"))


@query("scan_partitioned")
def q_scan_partitioned(spark: SparkSession, root: str) -> DataFrame:
    return batches.read_root(spark, bronze_lake(spark, root))


register("scan_partitioned", with_trips("SELECT * FROM raw"))


@query("partition_pruned_count")
def q_partition_pruned_count(spark: SparkSession, root: str) -> DataFrame:
    lake = batches.read_root(spark, bronze_lake(spark, root))
    return lake.filter((F.col("year") == SCAN_YEAR) & (F.col("month") == SCAN_MONTH)).agg(
        F.count(F.lit(1)).alias("n_rows"))


register("partition_pruned_count", with_trips(
    f"SELECT count(*) AS n_rows FROM raw WHERE year = {SCAN_YEAR} AND month = {SCAN_MONTH}"))


@query("replace_batch")
def q_replace_batch(spark: SparkSession, root: str) -> DataFrame:
    """Silver for all months, from the bronze lake, then month 1997-05 reloaded from there in corrected form (rows
    without a passenger count dropped) through the staged, reconciled batch replace."""
    target, lake = scratch_path(spark, "silver-trips"), batches.read_root(spark, bronze_lake(spark, root))
    batches.write_batches(accepted_trips(lake), target, ["year", "month"], files_per_batch=0)
    month = lake.filter((F.col("year") == SCAN_YEAR) & (F.col("month") == SCAN_MONTH))
    corrected = accepted_trips(month).filter(F.col("passenger_count").isNotNull())
    batches.replace_batches(spark, corrected, target, ["year", "month"])
    return batches.read_root(spark, target)


register("replace_batch", with_trips(f"""
SELECT * FROM silver WHERE NOT (year = {SCAN_YEAR} AND month = {SCAN_MONTH})
UNION ALL
SELECT * FROM silver WHERE year = {SCAN_YEAR} AND month = {SCAN_MONTH} AND passenger_count IS NOT NULL"""))


@query("changed_months")
def q_changed_months(spark: SparkSession, root: str) -> DataFrame:
    src = staged(spark, root).withColumn("source_month", month_key("pickup_at"))
    target = src.filter(F.col("source_month") < HWM_BEFORE)
    return incremental.changed_batches(src, target, "source_month", "loaded_at")


register("changed_months", with_all(f"""
SELECT DISTINCT strftime(pickup_at, '%Y-%m') AS source_month FROM stg
WHERE loaded_at > (SELECT coalesce(max(loaded_at), TIMESTAMP '1900-01-01')
                   FROM stg WHERE strftime(pickup_at, '%Y-%m') < '{HWM_BEFORE}')"""))


def _read_fact(spark: SparkSession, path: str) -> DataFrame:
    # the batch key is text ('1997-05'); keep partition discovery from guessing a type
    schema = spark.read.option("mergeSchema", True).parquet(path).schema
    fixed = T.StructType([T.StructField(f.name, T.StringType(), True) if f.name == "source_month" else f
                          for f in schema.fields])
    return spark.read.schema(fixed).option("mergeSchema", True).parquet(path)


@query("fact_incremental")
def q_fact_incremental(spark: SparkSession, root: str) -> DataFrame:
    """Full build of the fact, then a rebuild of named months from a reload whose rows carry
    a later ``loaded_at``: exactly those months are replaced (delete + insert)."""
    path = scratch_path(spark, "fct-trips")
    f = fact(spark, root, trips=silver_lake(spark, root))
    incremental.build_incremental(spark, f, path, full_refresh=True, files_per_batch=0)
    reload = f.withColumn("loaded_at", F.timestamp_add("DAY", F.lit(RELOAD_SHIFT_DAYS), F.col("loaded_at")))
    incremental.build_incremental(spark, reload, path, months=REBUILD_MONTHS)
    return _read_fact(spark, path)


register("fact_incremental", with_all(f"""
SELECT * REPLACE (CASE WHEN source_month IN ({", ".join(f"'{m}'" for m in REBUILD_MONTHS)})
                       THEN loaded_at + INTERVAL {RELOAD_SHIFT_DAYS} DAY ELSE loaded_at END AS loaded_at)
FROM fct""", ENRICHED_CTE, FCT_CTE))


@query("schema_append")
def q_schema_append(spark: SparkSession, root: str) -> DataFrame:
    """A fact first built without ``weather_category``; two later months arrive with it.
    Reading with schema merge appends the column: older rows read null."""
    path = scratch_path(spark, "fct-append")
    f = fact(spark, root, trips=silver_lake(spark, root))
    incremental.build_incremental(spark, f.drop("weather_category"), path, full_refresh=True, files_per_batch=0)
    incremental.build_incremental(spark, f, path, months=APPEND_MONTHS)
    got = _read_fact(spark, path)
    return got.groupBy("source_month").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count("weather_category").alias("n_with_category"))


register("schema_append", with_all(f"""
SELECT source_month, count(*) AS n_rows,
       count(*) FILTER (WHERE source_month IN ({", ".join(f"'{m}'" for m in APPEND_MONTHS)})
                        AND weather_category IS NOT NULL) AS n_with_category
FROM fct GROUP BY source_month""", ENRICHED_CTE, FCT_CTE))


@query("schema_registered")
def q_schema_registered(spark: SparkSession, root: str) -> DataFrame:
    """The same, read by the columns registered beside the table: no footer is merged."""
    from lakeshore.sources import fields

    path = scratch_path(spark, "fct-registered")
    f = fact(spark, root, trips=silver_lake(spark, root))
    incremental.build_incremental(spark, f.drop("weather_category"), path, full_refresh=True, files_per_batch=0)
    incremental.build_incremental(spark, f, path, months=APPEND_MONTHS)
    got = fields.read(spark, path)
    since = F.broadcast(fields.registered(spark, path).where("name = 'weather_category'").agg(F.min("since").alias("category_since")))
    return got.groupBy("source_month").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count("weather_category").alias("n_with_category")).crossJoin(since)


register("schema_registered", with_all(f"""
SELECT source_month, count(*) AS n_rows,
       count(*) FILTER (WHERE source_month IN ({", ".join(f"'{m}'" for m in APPEND_MONTHS)})
                        AND weather_category IS NOT NULL) AS n_with_category,
       '{min(APPEND_MONTHS)}' AS category_since
FROM fct GROUP BY source_month""", ENRICHED_CTE, FCT_CTE))


# ---------------------------------------------------------------- drifting batch files

DRIFT_RENAMED, DRIFT_RETYPED, DRIFT_MISSING = "1996-01", "1997-01", "1998-01"

ORDERS_CONTRACT = [
    Field("o_orderkey", "o_orderkey", T.LongType()),
    Field("o_custkey", "o_custkey", T.LongType()),
    Field("o_orderstatus", "o_orderstatus", T.StringType()),
    Field("o_totalprice", "o_totalprice", T.DoubleType()),
    Field("o_orderdate", "o_orderdate", T.TimestampNTZType()),
    Field("o_orderpriority", "o_orderpriority", T.StringType(), default="UNKNOWN"),
]


def drifted_orders_lake(spark: SparkSession, root: str) -> dict[str, str]:
    """Orders landed as one folder per month; three months were written by a drifted
    producer: a column in other case, bigint -> double, a column missing."""
    base = scratch_path(spark, "orders-drift")
    o = table(spark, root, "orders").withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    drift = [DRIFT_RENAMED, DRIFT_RETYPED, DRIFT_MISSING]
    batches.write_batches(o.filter(~F.col("period").isin(drift)), base, ["period"])
    o.filter(F.col("period") == DRIFT_RENAMED).drop("period").withColumnRenamed(
        "o_totalprice", "O_TotalPrice").write.parquet(f"{base}/period={DRIFT_RENAMED}")
    o.filter(F.col("period") == DRIFT_RETYPED).drop("period").withColumn(
        "o_custkey", F.col("o_custkey").cast("double")).write.parquet(f"{base}/period={DRIFT_RETYPED}")
    o.filter(F.col("period") == DRIFT_MISSING).drop("period", "o_orderpriority").write.parquet(
        f"{base}/period={DRIFT_MISSING}")
    folders = batches.leaf_folders(spark, base)
    return {f.rsplit("=", 1)[1]: f for f in folders}


@query("schema_drift")
def q_schema_drift(spark: SparkSession, root: str) -> DataFrame:
    folders = drifted_orders_lake(spark, root)
    return schema_drift(batches.footer_schemas(spark, folders))


def _drift_sql() -> str:
    cols = [("o_orderkey", "'bigint'"),
            ("o_custkey", f"CASE WHEN period = '{DRIFT_RETYPED}' THEN 'double' ELSE 'bigint' END"),
            ("o_orderstatus", "'string'"),
            ("o_totalprice", f"CASE WHEN period = '{DRIFT_RENAMED}' THEN 'MISSING' ELSE 'double' END"),
            ("O_TotalPrice", f"CASE WHEN period = '{DRIFT_RENAMED}' THEN 'double' ELSE 'MISSING' END"),
            ("o_orderdate", "'timestamp_ntz'"),
            ("o_orderpriority", f"CASE WHEN period = '{DRIFT_MISSING}' THEN 'MISSING' ELSE 'string' END")]
    grid = "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", period, {t} AS type FROM periods" for c, t in cols)
    return f"""
WITH periods AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period FROM orders),
grid AS ({grid}),
per_column AS (SELECT "column", count(DISTINCT type) > 1 AS differs FROM grid GROUP BY "column")
SELECT g."column", g.period, g.type, p.differs,
       CASE WHEN lower(g."column") = 'o_totalprice' THEN 'O_TotalPrice,o_totalprice' END AS spellings
FROM grid g JOIN per_column p USING ("column")"""


register("schema_drift", _drift_sql())


@query("conform_drifted")
def q_conform_drifted(spark: SparkSession, root: str) -> DataFrame:
    """All drifted month folders read in one job per schema group and conformed."""
    return batches.read_batches(spark, drifted_orders_lake(spark, root), ORDERS_CONTRACT)


register("conform_drifted", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN strftime(o_orderdate, '%Y-%m') = '{DRIFT_MISSING}' THEN 'UNKNOWN' ELSE o_orderpriority END AS o_orderpriority,
       strftime(o_orderdate, '%Y-%m') AS period
FROM orders""")


@query("file_manifest")
def q_file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Manifest of the bronze lake after a second landing: files of the first landing are
    'skipped' (same path and size), new ones 'downloaded'. Per batch: rows and status."""
    path = scratch_path(spark, "bronze-landing")
    raw = standins.raw_trips(spark, root, by_batch=True)
    batches.write_batches(raw.filter(F.col("year") < MANIFEST_SPLIT_YEAR), path, ["year", "month"], files_per_batch=0)
    first = batches.file_manifest(spark, path)
    first_path = scratch_path(spark, "manifest")
    first.write.mode("overwrite").parquet(first_path)           # the manifest of record
    batches.write_batches(raw.filter(F.col("year") >= MANIFEST_SPLIT_YEAR), path, ["year", "month"], files_per_batch=0)
    second = batches.file_manifest(spark, path, spark.read.parquet(first_path))
    folder = lambda c: batches.folder_value(F.col("file_path"), c).cast("int")
    period = F.format_string("%04d-%02d", folder("year"), folder("month"))
    return second.groupBy(period.alias("period"), "status").agg(F.sum("row_count").alias("row_count"))


register("file_manifest", with_trips(f"""
SELECT printf('%04d-%02d', year, month) AS period,
       CASE WHEN year < {MANIFEST_SPLIT_YEAR} THEN 'skipped' ELSE 'downloaded' END AS status,
       count(*) AS row_count
FROM raw GROUP BY year, month"""))


# ---------------------------------------------------------------- type-2 history

def history_after_runs(spark: SparkSession, root: str) -> DataFrame:
    """Three scheduled runs (v1, v2, v3) against one stored history table: each run reads
    the open versions only, writes the versions it closes and replaces the open ones."""
    path = scratch_path(spark, "history")
    h = None
    for i, (version, run_at) in enumerate(zip(standins.customer_versions(spark, root), standins.HISTORY_RUNS)):
        h = history.scd2_run(spark, version, path, standins.HISTORY_KEY, standins.HISTORY_CHECK, run_at,
                             first_run=(i == 0))
    return h.drop(history.STATE_COL)


@query("scd2")
def q_scd2(spark: SparkSession, root: str) -> DataFrame:
    return history_after_runs(spark, root)


T1, T2, T3 = standins.HISTORY_RUNS
HISTORY_SQL = f"""
v1 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment, c_acctbal FROM customer),
v2 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_acctbal > {standins.PREMIUM_BALANCE} THEN 'PREMIUM' ELSE c_mktsegment END AS c_mktsegment,
              c_acctbal
       FROM customer WHERE c_nationkey <> {standins.LEAVING_NATION}),
ins AS (SELECT c_custkey + {standins.INSERTED_KEY_OFFSET} AS c_custkey, c_name, c_nationkey, c_mktsegment
        FROM customer WHERE c_nationkey = {standins.EXPANDING_NATION}),
hist AS (
  -- leaving customers: v1 version closed at the second run, re-opened at the third
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{T1}' AS valid_from, TIMESTAMP '{T2}' AS valid_to
  FROM v1 WHERE c_nationkey = {standins.LEAVING_NATION}
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{T3}', CAST(NULL AS TIMESTAMP)
  FROM v1 WHERE c_nationkey = {standins.LEAVING_NATION}
  UNION ALL
  -- changed at the second run (segment filled in or re-segmented)
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{T1}', TIMESTAMP '{T2}' FROM v1
  WHERE c_nationkey <> {standins.LEAVING_NATION} AND (c_acctbal < 0 OR c_acctbal > {standins.PREMIUM_BALANCE})
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{T2}', CAST(NULL AS TIMESTAMP) FROM v2
  WHERE c_acctbal < 0 OR c_acctbal > {standins.PREMIUM_BALANCE}
  UNION ALL
  -- unchanged
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{T1}', CAST(NULL AS TIMESTAMP) FROM v1
  WHERE c_nationkey <> {standins.LEAVING_NATION} AND c_acctbal >= 0 AND c_acctbal <= {standins.PREMIUM_BALANCE}
  UNION ALL
  -- new accounts
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{T2}', CAST(NULL AS TIMESTAMP) FROM ins),
history AS (
  SELECT *, md5(CAST(c_custkey AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR)) AS version_id FROM hist)"""

register("scd2", f"WITH {HISTORY_SQL}\nSELECT * FROM history")


@query("scd2_asof")
def q_scd2_asof(spark: SparkSession, root: str) -> DataFrame:
    """Every event labelled with its user's customer attributes valid at the event time."""
    ev = table(spark, root, "events").select("event_id", "user_id", "ts")
    return history.as_of(ev, "ts", history_after_runs(spark, root), {"user_id": "c_custkey"},
                         ["c_name", "c_mktsegment"])


register("scd2_asof", f"""WITH {HISTORY_SQL}
SELECT e.event_id, e.user_id, e.ts, h.c_name, h.c_mktsegment
FROM events e LEFT JOIN history h
  ON h.c_custkey = e.user_id AND h.valid_from <= e.ts
 AND e.ts < coalesce(h.valid_to, TIMESTAMP '9999-12-31 23:59:59')""")


@query("scd2_asof_sorted")
def q_scd2_asof_sorted(spark: SparkSession, root: str) -> DataFrame:
    """The same by sorting: versions and events in one run per key, the last version carried forward."""
    from lakeshore.operators.asof import as_of_sorted

    ev = table(spark, root, "events").select("event_id", "user_id", "ts")
    return as_of_sorted(ev, "ts", history_after_runs(spark, root), {"user_id": "c_custkey"}, ["c_name", "c_mktsegment"])


register("scd2_asof_sorted", f"""WITH {HISTORY_SQL}
SELECT e.event_id, e.user_id, e.ts, h.c_name, h.c_mktsegment
FROM events e LEFT JOIN history h
  ON h.c_custkey = e.user_id AND h.valid_from <= e.ts
 AND e.ts < coalesce(h.valid_to, TIMESTAMP '9999-12-31 23:59:59')""")


# ---------------------------------------------------------------- streaming landing

@query("landing_stream")
def q_landing_stream(spark: SparkSession, root: str) -> DataFrame:
    """Bronze batch files landed, then cleaned by an available-now file stream (each file
    exactly once); the silver it publishes equals the batch split's accepted rows."""
    from lakeshore.streaming.landing import EPOCH_COL, clean_landed_files, run_to_completion

    lake = bronze_lake(spark, root)
    schema = spark.read.parquet(lake).schema
    target = scratch_path(spark, "stream-trips")
    q = clean_landed_files(spark, lake, schema, lambda df: clean_trips(df, standins.STANDIN_TRIPS),
                           target, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=1000)
    run_to_completion(q)
    return spark.read.parquet(target).where("layer = 'accepted'").drop(EPOCH_COL, "layer", "reject_reason")


register("landing_stream", with_trips("SELECT * FROM silver"))


@query("clean_publish")
def q_clean_publish(spark: SparkSession, root: str) -> DataFrame:
    """Bronze batches cleaned and published (accepted + quarantined) in one write: the input is read once, counted
    while it is written (and per batch by its footers) and compared with the files; the reconciliation per batch."""
    from lakeshore.plans.pipelines import publish_clean

    path = bronze_lake(spark, root)
    folder = lambda c: batches.folder_value(F.col("file"), c).cast("int").alias(c)
    landed = batches.file_rows(spark, path).groupBy(folder("year"), folder("month")).agg(F.sum("row_count"))
    return publish_clean(spark, batches.read_root(spark, path), scratch_path(spark, "trips-published"), standins.STANDIN_TRIPS,
                         expected={tuple(r[:-1]): r[-1] for r in landed.collect()}, files_per_batch=0)


register("clean_publish", with_trips("""
SELECT year, month, count(*) AS input_rows,
       count(*) FILTER (WHERE reject_reason IS NULL) AS accepted_rows,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS quarantined_rows,
       true AS reconciled
FROM clean GROUP BY year, month"""))


# ---------------------------------------------------------------- second runs

CORRECTED = (1997, 3)
RECALLED = (1998, 5)


@query("landing_republished")
def q_landing_republished(spark: SparkSession, root: str) -> DataFrame:
    """All bronze batches landed, then one published again without the rows of odd vendors and one taken back: a second run
    cleans the changed batch alone, and empties the other. Rows per layer as they lie on disk."""
    from lakeshore.plans.landed import land_changed
    from lakeshore.plans.pipelines import LAYER_COL, read_clean

    lake, p = bronze_lake(spark, root), standins.STANDIN_TRIPS
    target, ledger = scratch_path(spark, "landed-trips"), scratch_path(spark, "landed-ledger")
    land_changed(spark, lake, target, ledger, p)
    of = lambda month: (F.col("year") == month[0]) & (F.col("month") == month[1])
    corrected = batches.read_root(spark, lake).where(of(CORRECTED) & (F.col("VendorID") % 2 == 0))
    batches.write_batches(materialize(spark, corrected, "corrected"), lake, ["year", "month"])     # stored: it replaces what it reads
    batches.purge_partitions(spark, lake, [dict(zip(("year", "month"), RECALLED, strict=True))])
    land_changed(spark, lake, target, ledger, p)
    return read_clean(spark, target, p).groupBy("year", "month").agg(
        F.count_if(F.col(LAYER_COL) == "accepted").alias("accepted_rows"),
        F.count_if(F.col(LAYER_COL) == "quarantined").alias("quarantined_rows"))


register("landing_republished", with_trips(f"""
SELECT year, month, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted_rows,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS quarantined_rows
FROM clean
WHERE NOT (year = {RECALLED[0]} AND month = {RECALLED[1]})
  AND (year <> {CORRECTED[0]} OR month <> {CORRECTED[1]} OR vendor_id % 2 = 0)
GROUP BY year, month"""))


@query("republish_clean")
def q_republish_clean(spark: SparkSession, root: str) -> DataFrame:
    """All batches published, then one again after its faulty rows were taken out at the source: its
    quarantine is emptied, the other batches stay. Rows per layer as they lie on disk."""
    from lakeshore.plans.pipelines import LAYER_COL, publish_clean, read_clean

    path, p = scratch_path(spark, "republished"), standins.STANDIN_TRIPS
    raw = standins.raw_trips(spark, root, by_batch=True)
    publish_clean(spark, raw, path, p, files_per_batch=0)
    month = raw.where((F.col("year") == CORRECTED[0]) & (F.col("month") == CORRECTED[1]))
    good = clean_trips(month, p).where("reject_reason IS NULL").select(*[f.target for f in p.contract], *p.batch_cols)
    publish_clean(spark, good, path, p, conformed=True)
    return read_clean(spark, path, p).groupBy("year", "month").agg(
        F.count_if(F.col(LAYER_COL) == "accepted").alias("accepted_rows"),
        F.count_if(F.col(LAYER_COL) == "quarantined").alias("quarantined_rows"))


register("republish_clean", with_trips(f"""
SELECT year, month, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted_rows,
       count(*) FILTER (WHERE reject_reason IS NOT NULL AND (year <> {CORRECTED[0]} OR month <> {CORRECTED[1]})) AS quarantined_rows
FROM clean GROUP BY year, month"""))

DROPPED_BEFORE = "1996-01"


@query("full_refresh_drop")
def q_full_refresh_drop(spark: SparkSession, root: str) -> DataFrame:
    """A table built from all order months, then refreshed in full from a source without the first year."""
    from lakeshore.operators.incremental import build_incremental

    path = scratch_path(spark, "refreshed")
    o = table(spark, root, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("source_month"))
    build_incremental(spark, o, path, full_refresh=True)
    build_incremental(spark, o.where(F.col("source_month") >= DROPPED_BEFORE), path, full_refresh=True)
    return spark.read.parquet(path).groupBy(F.col("source_month").cast("string").alias("source_month")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest"))


register("full_refresh_drop", f"""
SELECT strftime(o_orderdate, '%Y-%m') AS source_month, count(*) AS orders, max(o_totalprice) AS largest
FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '{DROPPED_BEFORE}' GROUP BY 1""")


@query("scd2_all_closed")
def q_scd2_all_closed(spark: SparkSession, root: str) -> DataFrame:
    """A history whose keys all leave: every version is closed, none is open any more."""
    path = scratch_path(spark, "all-closed")
    v1 = standins.customer_versions(spark, root)[0]
    key, check, runs = standins.HISTORY_KEY, standins.HISTORY_CHECK, standins.HISTORY_RUNS
    history.scd2_run(spark, v1, path, key, check, runs[0])
    h = history.scd2_run(spark, v1.limit(0), path, key, check, runs[1])
    return h.select(*key, *check, "valid_from", "valid_to", F.col(history.STATE_COL).cast("string").alias("state"))


register("scd2_all_closed", f"""
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment,
       TIMESTAMP '{standins.HISTORY_RUNS[0]}' AS valid_from, TIMESTAMP '{standins.HISTORY_RUNS[1]}' AS valid_to,
       'closed {standins.HISTORY_RUNS[1]}' AS state
FROM customer""")

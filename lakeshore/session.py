"""Session helpers: a UTC-pinned, AQE-enabled SparkSession and a shared scratch area.

Wall-clock columns are TIMESTAMP_NTZ; any conversion through a zoned timestamp
(`date_trunc`, `from_utc_timestamp`) is only correct when the session zone is UTC,
so every entry point calls :func:`require_utc`.
"""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # on a shared cluster, coalesce shuffle partitions to the advisory size rather than to
    # the core count (Spark's recommendation for busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # partition overwrite replaces only the batches present in the written rows
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "lakeshore", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings the library relies on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    scratch_root(spark)
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(
            f"session time zone is {zone!r}; wall-clock arithmetic needs spark.sql.session.timeZone=UTC"
        )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir`` or, where
    that is unset, a folder in the warehouse, which the driver and all executors share as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared scratch root."""
    root = scratch_root(spark)
    return f"{root}/lakeshore/{name}-{uuid.uuid4().hex[:12]}"   # writers create it


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables below the scratch root: for the end of a run, when no result
    that reads them is needed any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/lakeshore")
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` as a Parquet table in the shared scratch folder and return its re-read.

    For small, reused intermediate tables (calendar-sized dimensions, hourly aggregates):
    computed once, read cheaply by every consumer and by size checks, and the lineage is
    cut (an executor lost later does not recompute the upstream plan)."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)    # the schema just written: no inference


def materialize_all(spark: SparkSession, frames: dict, also=()):
    """:func:`materialize` several independent frames as concurrent Spark jobs (submitted
    from driver threads; each is small, so they share the executors instead of queueing).
    ``also``: further independent zero-argument actions (checks) run alongside."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, len(frames) + len(also))) as pool:
        futures = {name: pool.submit(materialize, spark, df, name) for name, df in frames.items()}
        extra = [pool.submit(fn) for fn in also]
        for f in extra:
            f.result()                      # re-raises a failed check
        return {name: f.result() for name, f in futures.items()}

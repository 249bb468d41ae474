"""Type-2 slowly changing history of a lookup, and as-of reading of it.

A history row is one *version* of a key: its check columns, ``valid_from``, ``valid_to``
(null = current) and a version id. A run compares the current snapshot with the open
versions (full outer join on the key, null-safe compare of the check columns):
unchanged keys keep their open version, changed keys close it and open a new one,
keys gone from the snapshot are closed (hard deletes), new or re-appearing keys open a
version. Closed versions are never touched again, so a re-run with the same snapshot
changes nothing.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAR_FUTURE = "9999-12-31 23:59:59"


def _version_id(keys: Sequence[str], ts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], ts.cast("string")))


def scd2(current: DataFrame, previous: DataFrame | None, keys: Sequence[str], check: Sequence[str], run_at,
         close_missing: bool = True) -> DataFrame:
    """New full history after one run at instant ``run_at`` (a parameter, never the clock)."""
    run = F.lit(run_at).cast("timestamp_ntz")
    cols = [*keys, *check]
    snap = current.select(*cols)
    if previous is None:
        return snap.select(*cols, run.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                           _version_id(keys, run).alias("version_id"))
    closed = previous.filter(F.col("valid_to").isNotNull())
    open_ = previous.filter(F.col("valid_to").isNull())
    p = open_.select(*[F.col(c).alias(f"p_{c}") for c in cols], F.col("valid_from").alias("p_from"),
                     F.col("version_id").alias("p_id"))
    s = snap.select(*[F.col(c).alias(f"s_{c}") for c in cols])
    j = p.join(s, reduce(lambda a, b: a & b, [F.col(f"p_{k}") == F.col(f"s_{k}") for k in keys]), "full_outer")
    in_prev = F.col(f"p_{keys[0]}").isNotNull()
    in_snap = F.col(f"s_{keys[0]}").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"p_{c}").eqNullSafe(F.col(f"s_{c}")) for c in check])

    keep_or_close = j.filter(in_prev).select(
        *[F.col(f"p_{c}").alias(c) for c in cols], F.col("p_from").alias("valid_from"),
        F.when(in_snap & same, F.lit(None).cast("timestamp_ntz"))
         .when(in_snap | F.lit(close_missing), run)
         .otherwise(F.lit(None).cast("timestamp_ntz")).alias("valid_to"),
        F.col("p_id").alias("version_id"))
    opened = j.filter(in_snap & (~in_prev | ~same)).select(
        *[F.col(f"s_{c}").alias(c) for c in cols], run.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    opened = opened.withColumn("version_id", _version_id(keys, F.col("valid_from")))
    return closed.select(*cols, "valid_from", "valid_to", "version_id").unionByName(keep_or_close).unionByName(opened)


def as_of(facts: DataFrame, ts: str, history: DataFrame, keys: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """Each fact row with the history ``columns`` of the version valid at its ``ts``
    (valid_from <= ts < valid_to, open versions unbounded); null when none was valid.
    An equi join on the key plus a range condition: versions per key are few, so the
    output keeps exactly the fact rows."""
    h = history.select(*[F.col(k).alias(f"__h_{k}") for k in keys.values()],
                       F.col("valid_from").alias("__from"),
                       F.coalesce(F.col("valid_to"), F.lit(FAR_FUTURE).cast("timestamp_ntz")).alias("__to"),
                       *columns)
    cond = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__h_{k}") for f, k in keys.items()])
    cond = cond & (F.col("__from") <= F.col(ts)) & (F.col(ts) < F.col("__to"))
    return facts.join(h, cond, "left").drop(*[f"__h_{k}" for k in keys.values()], "__from", "__to")


STATE_COL = "version_state"
OPEN = "open"


def scd2_run(spark, snapshot: DataFrame, root: str, keys: Sequence[str], check: Sequence[str], run_at,
             close_missing: bool = True, stage: str | None = None, first_run: bool | None = None) -> DataFrame:
    """One scheduled history run against a stored history at ``root``, touching only what
    can change. The table is partitioned by ``version_state``: 'open' holds current versions,
    'closed <run instant>' the versions a run closed. A run reads only the open partition and
    stages its result in the shared scratch area. It publishes the versions it closed first, then
    replaces the open partition (which is emptied if no version is open any more): a run that dies
    between the two still finds the old open versions, and its repetition writes the same rows again.
    Earlier closed partitions are never touched. Returns the stored history (all versions)."""
    from lakeshore.session import scratch_path
    from lakeshore.sources.batches import exists, purge_partitions

    fresh = not exists(spark, root) if first_run is None else first_run
    open_ = None if fresh else spark.read.parquet(root).filter(F.col(STATE_COL) == OPEN).drop(STATE_COL)
    result = scd2(snapshot, open_, keys, check, run_at, close_missing)
    tag = F.when(F.col("valid_to").isNull(), F.lit(OPEN)).otherwise(
        F.concat(F.lit("closed "), F.col("valid_to").cast("string")))
    stage = stage or scratch_path(spark, "history-run")
    result.withColumn(STATE_COL, tag).write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    for part in (staged.filter(F.col(STATE_COL) != OPEN), staged.filter(F.col(STATE_COL) == OPEN)):
        (part.hint("rebalance", STATE_COL).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(STATE_COL).parquet(root))
    if not fresh and staged.filter(F.col(STATE_COL) == OPEN).isEmpty():
        purge_partitions(spark, root, [{STATE_COL: OPEN}])
    return spark.read.schema(staged.schema).parquet(root)

"""Publishing a second time: corrected batches, full refreshes, histories whose keys leave; and
checks that fail leave the target as it was."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import history, incremental
from lakeshore.operators.rules import ReconcileError
from lakeshore.plans.pipelines import publish_clean, read_clean
from lakeshore.plans.trips import TAXI
from lakeshore.session import scratch_path
from lakeshore.sources import batches

DDL = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
       "trip_distance double, RatecodeID double, store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type int, "
       "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
       "total_amount double, congestion_surcharge double, Airport_fee double, year int, month int")


def trips(spark, minutes, month=1):
    at = dt.datetime(2025, 1 if month is None else month, 5, 10)
    rows = [(1, at, at + dt.timedelta(minutes=m), 1.0, 2.0, 1.0, "N", 4, 5, 1, 10.0, 0.0, 0.5, 2.0, 0.0, 1.0, 13.5, 2.5, 0.0, 2025, month)
            for m in minutes]
    return spark.createDataFrame(rows, DDL)


def layers(spark, root):
    return {(r.layer, r.month): r[2] for r in read_clean(spark, root, TAXI).groupBy("layer", "month").count().collect()}


def test_corrected_month_replaces_both_layers(spark):
    root = scratch_path(spark, "t-second")
    first = publish_clean(spark, trips(spark, [10, -3]).unionByName(trips(spark, [5], 2)), root, TAXI)
    assert {(r.month, r.input_rows, r.accepted_rows, r.quarantined_rows, r.reconciled) for r in first.collect()} == {
        (1, 2, 1, 1, True), (2, 1, 1, 0, True)}
    again = publish_clean(spark, trips(spark, [10, 12]), root, TAXI)
    assert [tuple(r)[2:] for r in again.collect()] == [(2, 2, 0, True)]
    assert layers(spark, root) == {("accepted", 1): 2, ("accepted", 2): 1}
    publish_clean(spark, trips(spark, [-1]), root, TAXI)            # and the other way round
    assert layers(spark, root) == {("quarantined", 1): 1, ("accepted", 2): 1}


def test_wrong_count_publishes_nothing(spark):
    root = scratch_path(spark, "t-wrong")
    publish_clean(spark, trips(spark, [10, -3]), root, TAXI)
    before = layers(spark, root)
    with pytest.raises(ReconcileError):
        publish_clean(spark, trips(spark, [1, 2, 3]), root, TAXI, expected={(2025, 1): 4})
    assert layers(spark, root) == before
    target = scratch_path(spark, "t-wrong-batch")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x int, k string")
    batches.replace_batches(spark, df, target, ["k"])
    with pytest.raises(ReconcileError):
        batches.replace_batches(spark, df.where("x = 1"), target, ["k"], expected={("a",): 2})
    assert spark.read.parquet(target).count() == 3


def test_null_and_many_batches(spark):
    target = scratch_path(spark, "t-null")
    df = spark.range(600).select(F.col("id").alias("x"), F.when(F.col("id") % 300 > 0, (F.col("id") % 300).cast("string")).alias("k"))
    for _ in range(2):
        assert len(batches.replace_batches(spark, df, target, ["k"], files_per_batch=1)) == 300
    assert spark.read.parquet(target).count() == 600
    batches.replace_batches(spark, df.where("k IS NULL AND x = 0"), target, ["k"])
    assert spark.read.parquet(target).where("k IS NULL").count() == 1 and spark.read.parquet(target).count() == 599


def test_full_refresh_drops_what_the_source_lost(spark):
    target = scratch_path(spark, "t-refresh")
    rows = [("2024-01", 1, dt.datetime(2024, 2, 1)), ("2024-02", 2, dt.datetime(2024, 3, 1))]
    src = spark.createDataFrame(rows, "source_month string, x int, loaded_at timestamp_ntz")
    incremental.build_incremental(spark, src, target)
    incremental.build_incremental(spark, src.where("x = 2"), target, full_refresh=True)
    assert [r.x for r in spark.read.parquet(target).collect()] == [2]


def test_late_input_triggers_its_month(spark):
    target = scratch_path(spark, "t-late")
    rows = [("2024-01", 1, dt.datetime(2024, 2, 1)), ("2024-02", 2, dt.datetime(2024, 3, 1))]
    src = spark.createDataFrame(rows, "source_month string, x int, loaded_at timestamp_ntz")
    incremental.build_incremental(spark, src, target)
    late = spark.createDataFrame([("2024-01", dt.datetime(2024, 3, 5))], "source_month string, loaded_at timestamp_ntz")
    changed = src.withColumn("x", F.col("x") * 10)
    assert incremental.build_incremental(spark, changed, target) == {}
    assert incremental.build_incremental(spark, changed, target, extra_sources=[late]) == {("2024-01",): 1}
    assert sorted(r.x for r in spark.read.parquet(target).collect()) == [2, 10]


def test_unreadable_target_is_an_error(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"no parquet")
    src = spark.createDataFrame([("2024-01", 1, dt.datetime(2024, 2, 1))], "source_month string, x int, loaded_at timestamp_ntz")
    with pytest.raises(Exception):
        incremental.build_incremental(spark, src, str(tmp_path / "broken"))
    snap = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception):
        history.scd2_run(spark, snap, str(tmp_path / "broken"), ["k"], ["v"], "2024-01-01 00:00:00")
    assert not batches.exists(spark, str(tmp_path / "nothing")) and batches.exists(spark, str(tmp_path / "broken"))


def test_history_whose_keys_all_leave(spark):
    root = scratch_path(spark, "t-leave")
    snap = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    history.scd2_run(spark, snap, root, ["k"], ["v"], "2024-01-01 00:00:00")
    for _ in range(2):                                              # repeated run: the same rows
        h = history.scd2_run(spark, snap.limit(0), root, ["k"], ["v"], "2024-02-01 00:00:00").collect()
        assert len(h) == 2 and all(r.valid_to is not None for r in h)
    h = history.scd2_run(spark, snap.where("k = 1"), root, ["k"], ["v"], "2024-03-01 00:00:00")
    assert h.count() == 3 and [r.k for r in h.where("valid_to IS NULL").collect()] == [1]


def test_hot_key_is_split_in_a_sort_merge_join(spark):
    """as_of with broadcasts off and small partitions: AQE splits the hot user's rows."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("user"), F.xxhash64("id").alias("load"),
            F.expr("timestamp_ntz '2024-01-10 00:00:00'").alias("ts"))
        h = spark.range(5000).select(F.col("id").alias("k"), F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("valid_from"),
                                     F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit("v").alias("v"))
        out = history.as_of(facts, "ts", h, {"user": "k"}, ["v"])
        assert out.where("v IS NOT NULL").count() == 400_000
        rows = out.groupBy("v").agg(F.max("load"))
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

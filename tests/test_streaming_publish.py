"""Stream landing (each landed file exactly once), one-pass publish, session guards."""
import pytest
from pyspark.sql import functions as F

from lakeshore.operators.rules import ReconcileError  # noqa: F401  (public error type)
from lakeshore.plans import standins
from lakeshore.plans.pipelines import publish_clean
from lakeshore.plans.trips import clean_trips
from lakeshore.session import require_utc, scratch_path
from lakeshore.sources import batches
from lakeshore.streaming.landing import EPOCH_COL, clean_landed_files, run_to_completion

SF = "/root/testdata/sf0.001"


def test_landing_processes_each_file_once(spark):
    raw = standins.raw_trips(spark, SF)
    lake = scratch_path(spark, "t-bronze")
    batches.write_batches(raw.filter(F.col("year") < 1998), lake)
    schema = spark.read.parquet(lake).schema
    target, ckpt = scratch_path(spark, "t-landed"), scratch_path(spark, "t-ckpt")

    def land():
        q = clean_landed_files(spark, lake, schema, lambda df: clean_trips(df, standins.STANDIN_TRIPS),
                               target, ckpt, max_files_per_trigger=5)
        run_to_completion(q)
        return spark.read.parquet(target)

    early = raw.filter(F.col("year") < 1998).count()
    assert land().count() == early
    assert land().count() == early                           # nothing new landed: nothing reprocessed
    batches.write_batches(raw.filter(F.col("year") >= 1998), lake)   # later months land
    out = land()
    assert out.drop(EPOCH_COL).count() == raw.count()
    assert out.where("layer = 'accepted' AND reject_reason IS NOT NULL").count() == 0


def test_unfinished_landing_is_an_error():
    class Never:
        stopped = False

        def awaitTermination(self, timeout=None):
            return False

        def stop(self):
            self.stopped = True

    q = Never()
    with pytest.raises(TimeoutError):
        run_to_completion(q, 1)
    assert q.stopped


def test_publish_clean_reconciles(spark):
    raw = batches.read_root(spark, _lake(spark))
    out = publish_clean(spark, raw, scratch_path(spark, "t-published"), standins.STANDIN_TRIPS)
    rows = out.collect()
    assert all(r.reconciled for r in rows)
    assert sum(r.input_rows for r in rows) == raw.count()


def _lake(spark):
    lake = scratch_path(spark, "t-bronze2")
    batches.write_batches(standins.raw_trips(spark, SF), lake)
    return lake


def test_require_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    require_utc(spark)

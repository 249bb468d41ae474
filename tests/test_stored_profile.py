"""Profiles stored per batch: merged quantile sketches within their promise, distinct counts exact, one batch refreshed."""
import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeshore.operators import stored_profile as sp
from lakeshore.session import scratch_path

BATCH = ["year", "month"]


def data(spark, n=20_000):
    i = F.col("id")
    return spark.range(n).select(
        F.lit(2020).alias("year"), (F.pmod(i, F.lit(6)) + 1).cast("int").alias("month"),
        F.when(i % 50 != 0, F.pmod(i * 7919, F.lit(5003))).cast("double").alias("a"),
        F.when(i % 3 == 0, F.lit(1.0)).otherwise(F.sqrt(i)).alias("b"), F.lit(None).cast("double").alias("empty"),
        (F.lit(dt.datetime(1969, 12, 31)) + F.make_dt_interval(secs=F.pmod(i * 31, F.lit(9000)))).cast("timestamp_ntz").alias("at"))


def test_merged_quantiles_within_the_promise(spark):
    df, probs = data(spark), [0.01, 0.25, 0.5, 0.75, 0.99]
    sketches = sp.sketch_batches(df, BATCH, ["a", "b", "empty"])
    assert sketches.count() == 18
    merged = {r["column"]: r for r in sp.merged_quantiles(sketches, probs).collect()}
    assert merged["empty"].quantiles is None and merged["empty"].n_rows == 20_000 and merged["empty"].n_values == 0
    for c in ("a", "b"):
        values = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).collect())
        m = merged[c]
        assert (m.n_values, m.least, m.greatest) == (len(values), values[0], values[-1])
        for p, q in zip(probs, m.quantiles, strict=True):
            below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
            assert below - sp.RANK_ERROR <= p <= upto + sp.RANK_ERROR


def test_bitmaps_count_exactly(spark):
    df = data(spark)
    stored = sp.bitmap_batches(df, BATCH, "at")
    assert rows(sp.distinct_from_bitmaps(stored)) == rows(df.agg(F.count_distinct("at")))
    assert rows(sp.distinct_from_bitmaps(stored, ["month"])) == rows(df.groupBy("month").agg(F.count_distinct("at")))
    odd = spark.createDataFrame([(2020, 1, v) for v in (-1, 0, 1, -32768, 32768, 32769, 2**40, -1, None)], "year int, month int, v bigint")
    assert rows(sp.distinct_from_bitmaps(sp.bitmap_batches(odd, BATCH, "v"))) == [(7,)]
    t = dt.datetime(1960, 1, 1, 0, 0, 1)
    micros = spark.createDataFrame([(2020, 1, t + dt.timedelta(microseconds=m)) for m in (0, 1, -1, 999_999, 1_000_000, 0)],
                                   "year int, month int, v timestamp_ntz")
    assert rows(sp.distinct_from_bitmaps(sp.bitmap_batches(micros, BATCH, "v"))) == [(5,)]
    assert rows(sp.distinct_from_bitmaps(sp.bitmap_batches(odd.limit(0), BATCH, "v"))) == [(0,)]
    with pytest.raises(TypeError):
        sp.bitmap_batches(df, BATCH, "a")


def _files(store):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(store) for f in fs if f.endswith(".parquet")}


def test_one_changed_batch_is_read_and_replaced_alone(spark):
    lake, store = scratch_path(spark, "t-profiled"), scratch_path(spark, "t-bitmaps")
    data(spark).write.partitionBy(*BATCH).parquet(lake)
    profile = lambda d: sp.bitmap_batches(d, BATCH, "at")
    source = spark.read.parquet(lake)
    sp.refresh(spark, source, store, BATCH, profile)
    before = _files(store)
    other = data(spark, 60).where("month = 3").drop(*BATCH)
    other.write.mode("overwrite").parquet(f"{lake}/year=2020/month=3")
    changed = spark.createDataFrame([(2020, 3)], "year int, month int")
    now = spark.read.parquet(lake)
    stored = sp.refresh(spark, now, store, BATCH, profile, changed)
    after = _files(store)
    same = {f for f in before if "month=3/" not in f}
    assert same and all(after.get(f) == before[f] for f in same)
    assert rows(sp.distinct_from_bitmaps(stored, ["month"])) == rows(now.groupBy("month").agg(F.count_distinct("at")))
    stored = sp.refresh(spark, now.where("month <> 3"), store, BATCH, profile, changed)      # the batch is gone
    assert stored.where("month = 3").count() == 0 and stored.select("month").distinct().count() == 5

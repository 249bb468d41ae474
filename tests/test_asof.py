"""As-of lookup by sorting equals the join, and stays linear on a hot key with many versions."""
import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeshore.operators.asof import as_of_sorted
from lakeshore.operators.history import as_of

T0 = dt.datetime(2020, 1, 1)
FACTS = "id int, k int, at timestamp_ntz"
HISTORY = "key int, valid_from timestamp_ntz, valid_to timestamp_ntz, name string"


def day(n):
    return T0 + dt.timedelta(days=n)


def both(facts, history, **sizes):
    args = ("at", history, {"k": "key"}, ["name"])
    return rows(as_of_sorted(facts, *args, **sizes)), rows(as_of(facts, *args))


def small_history(spark):
    return spark.createDataFrame([
        (1, day(0), day(10), "a"), (1, day(10), day(20), "b"), (1, day(30), None, "c"),
        (2, day(5), day(5), "never"), (2, day(5), None, None), (None, day(0), None, "no key")], HISTORY)


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_equals_the_join(spark, hot_rows):
    facts = spark.createDataFrame(
        [(i, 1 + i % 3, day(i / 3)) for i in range(120)]
        + [(500, 1, day(10)), (501, 1, day(20)), (502, 1, day(-1)), (503, None, day(1)), (504, 1, None), (505, None, None),
           (506, 2, day(5)), (507, 1, day(10)), (507, 1, day(10))], FACTS)
    sorted_, joined = both(facts, small_history(spark), hot_rows=hot_rows, slices=8)
    assert sorted_ == joined and len(sorted_) == facts.count()


def test_hot_instant_and_empty_inputs(spark):
    history = small_history(spark)
    hot = spark.range(2000).select(F.col("id").cast("int"), F.lit(1).alias("k"), F.lit(day(10)).alias("at"))
    mixed = hot.unionByName(spark.createDataFrame([(9000 + i, 1, day(i)) for i in range(40)], FACTS))
    sorted_, joined = both(mixed, history, hot_rows=100, slices=16)
    assert sorted_ == joined
    none = spark.createDataFrame([], FACTS)
    assert rows(as_of_sorted(none, "at", history, {"k": "key"}, ["name"])) == []
    unversioned = as_of_sorted(mixed, "at", spark.createDataFrame([], HISTORY), {"k": "key"}, ["name"])
    assert unversioned.count() == 2040 and unversioned.where("name IS NOT NULL").count() == 0


def test_ten_thousand_versions_of_a_hot_key(spark):
    """A third of the facts and 10,000 versions on one key: no more rows than facts, versions and one a slice."""
    start = F.lit(T0).cast("timestamp_ntz")
    at = lambda minutes: (start + F.make_dt_interval(mins=minutes.cast("int"))).cast("timestamp_ntz")
    versions = spark.range(10_000).select(F.lit(7).alias("key"), at(F.col("id") * 10).alias("valid_from"),
                                          F.when(F.col("id") < 9_999, at((F.col("id") + 1) * 10)).alias("valid_to"),
                                          F.col("id").cast("string").alias("name"))
    facts = spark.range(60_000).select(F.col("id").cast("int"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"),
                                       at(F.pmod(F.col("id") * 7919, F.lit(110_000))).alias("at"))
    out = as_of_sorted(facts, "at", versions, {"k": "key"}, ["name"], hot_rows=1_000, slices=64)
    expected = F.when(F.col("k") == 7, F.least(F.floor(F.pmod(F.col("id") * 7919, F.lit(110_000)) / 10), F.lit(9_999)).cast("string"))
    assert out.count() == 60_000
    assert out.where(~F.col("name").eqNullSafe(expected)).count() == 0


def test_clashing_names(spark):
    facts = spark.createDataFrame([(1, 1, day(1))], FACTS).withColumn("name", F.lit("x"))
    with pytest.raises(ValueError, match="name"):
        as_of_sorted(facts, "at", small_history(spark), {"k": "key"}, ["name"])
    renamed = facts.withColumnRenamed("name", "valid_from")        # names of the history's own columns are free
    assert rows(as_of_sorted(renamed, "at", small_history(spark), {"k": "key"}, ["name"]), "valid_from", "name") == [("x", "a")]

"""Physical-plan properties the library relies on at scale (checked with explain output)."""
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lakeshore.operators import facts

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def executed(df):
    df.collect()                                   # final adaptive plan (not the initial one)
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_scan_reads_only_needed_columns(spark):
    plan = executed(E.queries()["split_accept"](spark, SF))
    scan = [line for line in plan.splitlines() if "lineitem.parquet" in line or "ReadSchema" in line]
    assert scan and not any("l_linestatus" in line for line in scan)   # unused column never read


def test_profile_checks_are_one_aggregate_over_one_scan(spark):
    plan = executed(E.queries()["profile_checks"](spark, SF))
    assert plan.count("FileScan parquet") == 2                         # lineitem + orders, once each
    assert plan.count("HashAggregate") == 2                            # partial + final of one agg


def test_group_by_is_partial_before_the_shuffle(spark):
    trips = spark.createDataFrame([(i % 5, i % 2 == 0) for i in range(100)], "h int, a boolean") \
        .withColumn("passenger_count", F.lit(1)).withColumn("duration_min", F.lit(1.0)) \
        .withColumn("trip_distance_miles", F.lit(1.0)).withColumn("total_amount", F.lit(1.0)) \
        .withColumn("tip_pct", F.lit(1.0)).withColumnRenamed("a", "is_airport_trip")
    plan = executed(facts.hourly_demand(trips, "h"))
    assert "partial_count" in plan and plan.index("partial_count") > plan.index("Exchange")


def test_batch_write_is_rebalanced(spark):
    from lakeshore.sources.batches import spread

    df = spark.range(100).withColumn("month", F.col("id") % 3)
    assert "RebalancePartitions" in spread(df, ["month"])._jdf.queryExecution().analyzed().toString()


def test_cleaning_is_computed_once_and_compiled(spark):
    """The rejection filter stays above the derived columns: not repeated in the join, no method too long to compile."""
    for key in ("split_accept", "split_quarantine", "reject_histogram"):
        df = E.queries()[key](spark, SF)
        spark.conf.set("spark.sql.adaptive.enabled", "false")       # a plan that is generated whole, before it runs
        try:
            plan = df._jdf.queryExecution().executedPlan()
            joins = [line for line in plan.toString().splitlines() if "Join" in line]
            assert joins and not any("timestampadd" in line for line in joins), key
            debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
            codes = getattr(debug, "MODULE$").codegenStringSeq(plan)
            sizes = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())]
            assert sizes and max(sizes) < 8000, (key, sizes)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")

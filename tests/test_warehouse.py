"""Star enrichment, holidays, dimensions and the anchored mart."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import dims, facts
from lakeshore.operators.enrich import Lookup, UniquenessError, enrich
from lakeshore.plans import warehouse


def test_enrich_preserves_rows_and_role_plays(spark):
    trips = spark.createDataFrame([(1, 10, 20), (2, 10, None), (3, 99, 10)], "id int, pu int, do int")
    zones = spark.createDataFrame([(10, "A"), (20, "B")], "location_id int, zone string")
    out = enrich(trips, [
        Lookup(zones, {"pu": "location_id"}, {"zone": "pickup_zone"}, broadcast=True),
        Lookup(zones, {"do": "location_id"}, {"zone": "dropoff_zone"}),
    ], check_unique=True)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10, 20, "A", "B"), (2, 10, None, "A", None),
                                                       (3, 99, 10, None, "A")]


def test_enrich_refuses_duplicate_right_keys(spark):
    trips = spark.createDataFrame([(1, 10)], "id int, pu int")
    zones = spark.createDataFrame([(10, "A"), (10, "A2")], "location_id int, zone string")
    with pytest.raises(UniquenessError):
        enrich(trips, [Lookup(zones, {"pu": "location_id"}, {"zone": "z"})], check_unique=True)


def test_statistics_decide_the_join(spark):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    lk = spark.range(10).select(F.col("id").alias("k2"), F.lit("x").alias("v"))
    plan = lambda: enrich(fact, [Lookup(lk, {"k": "k2"}, {"v": "v"})])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def holiday_frame(spark):
    recs = [("2025-01-01", "New Year", "NY", True, None, ["Public"]),
            ("2025-01-01", "Another", "A", False, ["US-NY", "US-CT"], None),
            ("2025-02-12", "Lincoln", "L", False, ["US-CT", "US-IL", "US-NYX"], ["Observance"]),
            ("2025-03-03", "Elsewhere", "E", False, ["US-CA"], None),
            ("2025-04-04", "Unknown flags", None, None, None, None)]
    df = spark.createDataFrame(recs, "date string, name string, localName string, global boolean, "
                                     "counties array<string>, types array<string>")
    return warehouse.stage_holidays(df)


def test_stage_holidays_keeps_null_lists_null(spark):
    got = {r.holiday_name: r for r in holiday_frame(spark).collect()}
    assert got["New Year"].observed_in is None and got["New Year"].holiday_types == "Public"
    assert got["Another"].observed_in == "US-NY,US-CT"


def test_holidays_for_region(spark):
    out = {r.holiday_date: r for r in dims.holidays_for(holiday_frame(spark), "US-NY").collect()}
    # two on one date are joined in name order; nationwide wins; null/null is dropped
    assert out[dt.date(2025, 1, 1)].holiday_name == "Another / New Year"
    assert out[dt.date(2025, 1, 1)].is_nationwide is True
    assert dt.date(2025, 3, 3) not in out and dt.date(2025, 4, 4) not in out
    # substring semantics of the joined list: 'US-NYX' contains 'US-NY'
    assert dt.date(2025, 2, 12) in out


def test_date_spine_and_empty_range(spark):
    d = spark.createDataFrame([(dt.date(2025, 2, 27),), (dt.date(2025, 3, 2),)], "d date")
    assert [r[0] for r in dims.date_spine(d, "d").collect()] == [dt.date(2025, 2, 27), dt.date(2025, 2, 28),
                                                                 dt.date(2025, 3, 1), dt.date(2025, 3, 2)]
    empty = spark.createDataFrame([(None,)], "d date")
    assert dims.date_spine(empty, "d").count() == 0


def test_date_dim_calendar(spark):
    spine = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 1, 1),)], "date_day date")
    hol = dims.holidays_for(holiday_frame(spark), "US-NY")
    got = {r.date_key: r for r in dims.date_dim(spine, hol).collect()}
    r = got[dt.date(2024, 12, 30)]
    assert (r.year, r.iso_week, r.day_of_week, r.day_name, r.month_name, r.quarter) == (2024, 1, 1, "Monday", "December", 4)
    assert got[dt.date(2025, 1, 1)].is_holiday and not r.is_holiday


def test_anchored_zero_fill(spark):
    cal = spark.createDataFrame([(1,), (2,), (3,)], "h int")
    by = spark.createDataFrame([(1, 5, 2.0), (3, 1, None)], "k int, trips long, avg double")
    out = {r.h: (r.trips, r.avg) for r in facts.anchored(cal, by, ("h", "k"), ["trips"]).collect()}
    assert out == {1: (5, 2.0), 2: (0, None), 3: (1, None)}


def test_totals_mismatch(spark):
    a = spark.range(5)
    b = spark.createDataFrame([(2,), (2,)], "trips long")
    assert facts.totals_mismatch(a, b, F.count(F.lit(1)), F.sum("trips")).count() == 1
    c = spark.createDataFrame([(2,), (3,)], "trips long")
    assert facts.totals_mismatch(a, c, F.count(F.lit(1)), F.sum("trips")).count() == 0


def test_named_views(spark):
    from lakeshore.sources.tables import register_views

    register_views(spark, "/root/testdata/sf0.001", ["nation", "region"])
    n = spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0]
    assert n == 25

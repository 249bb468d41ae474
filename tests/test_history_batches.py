"""Type-2 history runs, as-of reads, batch folders, batch replace and incremental builds."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import history, incremental
from lakeshore.operators.contract import Field
from lakeshore.session import scratch_path
from lakeshore.sources import batches

DDL = "k int, name string, seg string"
KEY, CHECK = ["k"], ["name", "seg"]
T1, T2, T3, T4 = "2025-01-01 00:00:00", "2025-02-01 00:00:00", "2025-03-01 00:00:00", "2025-04-01 00:00:00"


def run_history(spark, versions):
    prev = None
    for snap, t in versions:
        prev = history.scd2(spark.createDataFrame(snap, DDL), prev, KEY, CHECK, t)
        prev = spark.createDataFrame(prev.collect(), prev.schema)  # stored between runs
    return prev


def test_scd2_change_null_delete_reappear_and_rerun(spark):
    v1 = [(1, "a", "x"), (2, "b", None), (3, "c", "z"), (4, "d", "w")]
    v2 = [(1, "a", "x2"), (2, "b", "y"), (4, "d", "w"), (5, "e", "q")]     # change, null->value, delete 3, insert 5
    v3 = [(1, "a", "x2"), (2, "b", "y"), (3, "c", "z"), (4, "d", "w"), (5, "e", "q")]   # 3 re-appears
    h = run_history(spark, [(v1, T1), (v2, T2), (v3, T3)])
    got = sorted((r.k, str(r.seg), str(r.valid_from), str(r.valid_to)) for r in h.collect())
    assert got == [
        (1, "x", "2025-01-01 00:00:00", "2025-02-01 00:00:00"), (1, "x2", "2025-02-01 00:00:00", "None"),
        (2, "None", "2025-01-01 00:00:00", "2025-02-01 00:00:00"), (2, "y", "2025-02-01 00:00:00", "None"),
        (3, "z", "2025-01-01 00:00:00", "2025-02-01 00:00:00"), (3, "z", "2025-03-01 00:00:00", "None"),
        (4, "w", "2025-01-01 00:00:00", "None"),
        (5, "q", "2025-02-01 00:00:00", "None"),
    ]
    again = history.scd2(spark.createDataFrame(v3, DDL), h, KEY, CHECK, T4)      # unchanged re-run
    assert sorted(map(str, again.collect())) == sorted(map(str, h.collect()))
    assert h.select("version_id").distinct().count() == h.count()


def test_as_of(spark):
    h = run_history(spark, [([(1, "a", "x")], T1), ([(1, "a", "y")], T2)])
    facts = spark.createDataFrame([(10, 1, dt.datetime(2024, 12, 31)), (11, 1, dt.datetime(2025, 1, 15)),
                                   (12, 1, dt.datetime(2025, 2, 1)), (13, 2, dt.datetime(2025, 2, 2))],
                                  "id int, k int, ts timestamp_ntz")
    got = {r.id: r.seg for r in history.as_of(facts, "ts", h, {"k": "k"}, ["seg"]).collect()}
    assert got == {10: None, 11: "x", 12: "y", 13: None}


@pytest.fixture()
def lake(spark):
    return scratch_path(spark, "test-lake")


def month_rows(spark, months, tag="v1"):
    return spark.createDataFrame([(y, m, i, tag) for y, m in months for i in range(3)],
                                 "year int, month int, i int, tag string")


def test_partitioned_read_prunes_and_leaf_read_drops_folder_columns(spark, lake):
    batches.write_batches(month_rows(spark, [(2025, 1), (2025, 2)]), lake)
    root = batches.read_root(spark, lake)
    assert root.schema["month"].dataType.simpleString() == "int"
    pruned = root.filter("year = 2025 AND month = 2")
    assert "PartitionFilters" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 3
    leaf = batches.read_leaf(spark, lake, year=2025, month=1)
    assert "month" not in leaf.columns and leaf.count() == 3


def test_replace_batches_only_touches_present_batches_and_is_idempotent(spark, lake):
    batches.write_batches(month_rows(spark, [(2025, 1), (2025, 2)]), lake)
    new = month_rows(spark, [(2025, 2)], "v2").filter("i < 2")
    for _ in range(2):
        counts = batches.replace_batches(spark, new, lake)
        assert counts == {(2025, 2): 2}
    got = {(r.month, r.tag): r[2] for r in batches.read_root(spark, lake).groupBy("month", "tag").count().collect()}
    assert got == {(1, "v1"): 3, (2, "v2"): 2}


def test_incremental_build_named_and_changed_months(spark, lake):
    src = spark.createDataFrame([("2025-01", 1, dt.datetime(2025, 2, 1)), ("2025-02", 2, dt.datetime(2025, 3, 1))],
                                "source_month string, x int, loaded_at timestamp_ntz")
    incremental.build_incremental(spark, src, lake, full_refresh=True)
    newer = src.unionByName(spark.createDataFrame([("2025-03", 3, dt.datetime(2025, 4, 1))], src.schema))
    target = spark.read.parquet(lake)
    changed = [r[0] for r in incremental.changed_batches(newer, target).collect()]
    assert changed == ["2025-03"]
    same_mark = spark.createDataFrame([("2025-02", 9, dt.datetime(2025, 3, 1))], src.schema)
    assert incremental.changed_batches(same_mark, target).count() == 0      # strict '>'
    incremental.build_incremental(spark, newer, lake)                         # picks up 2025-03 only
    got = sorted((str(r.source_month), r.x) for r in spark.read.parquet(lake).collect())
    assert got == [("2025-01", 1), ("2025-02", 2), ("2025-03", 3)]
    # a named month with no new rows keeps its old rows
    incremental.build_incremental(spark, newer.filter("x = 3"), lake, months=["2025-01", "2025-03"])
    assert spark.read.parquet(lake).count() == 3


def test_read_batches_across_drift(spark, lake):
    spark.createDataFrame([(1, 2.5)], "id bigint, Fee double").write.parquet(f"{lake}/period=2025-01")
    spark.createDataFrame([(2.0, 1.0)], "id double, fee double").write.parquet(f"{lake}/period=2025-02")
    spark.createDataFrame([(3,)], "id bigint").write.parquet(f"{lake}/period=2025-03")
    folders = {p: f"{lake}/period={p}" for p in ["2025-01", "2025-02", "2025-03"]}
    contract = [Field("id", "id", "bigint"), Field("fee", "fee", "double", default=0.0)]
    got = sorted(tuple(r) for r in batches.read_batches(spark, folders, contract).collect())
    assert got == [(1, 2.5, "2025-01"), (2, 1.0, "2025-02"), (3, 0.0, "2025-03")]


def test_file_manifest_marks_known_files(spark, lake):
    batches.write_batches(month_rows(spark, [(2025, 1)]), lake)
    first = batches.file_manifest(spark, lake)
    first = spark.createDataFrame(first.collect(), first.schema)
    batches.write_batches(month_rows(spark, [(2025, 2)]), lake)
    second = batches.file_manifest(spark, lake, first)
    got = {re.search(r"month=(\d)", r.file_path).group(1): r.status for r in second.collect()}
    assert got == {"1": "skipped", "2": "downloaded"}
    assert second.agg(F.sum("row_count")).first()[0] == 6


def test_publish_series_and_gold_build(spark):
    from lakeshore.plans import q_marts, standins
    from lakeshore.plans.pipelines import build_gold, publish_series
    from lakeshore.plans.q_clean import staged

    root = "/root/testdata/sf0.001"
    docs = standins.weather_documents(spark, root)
    report = publish_series(spark, docs, standins.LOCAL_ZONE, scratch_path(spark, "silver-weather"))
    assert report.filter("within_tolerance").count() == report.count() > 0
    weather, holidays = q_marts.dimension_tables(spark, root)
    gold = scratch_path(spark, "gold")
    paths = build_gold(spark, staged(spark, root), weather, holidays, standins.zones(spark, root), gold,
                       full_refresh=True, airport_ids=standins.STANDIN_AIRPORT_ZONES)
    fact = spark.read.parquet(paths["fct_trips"])
    mart = spark.read.parquet(paths["agg_hourly_demand"])
    assert fact.count() == staged(spark, root).count()
    assert mart.count() == weather.count()
    dd = spark.read.parquet(paths["dim_date"])
    assert dd.select("date_key").distinct().count() == dd.count()


def test_scd2_run_stored_layout_and_idempotence(spark):
    root = scratch_path(spark, "hist-store")
    v1 = [(1, "a", "x"), (2, "b", "y")]
    v2 = [(1, "a", "x2")]                                      # change 1, delete 2
    history.scd2_run(spark, spark.createDataFrame(v1, DDL), root, KEY, CHECK, T1)
    h = history.scd2_run(spark, spark.createDataFrame(v2, DDL), root, KEY, CHECK, T2)
    states = {r[0]: r[1] for r in h.groupBy(history.STATE_COL).count().collect()}
    assert states == {"open": 1, f"closed {T2}": 2}
    before = sorted(map(str, h.collect()))
    again = history.scd2_run(spark, spark.createDataFrame(v2, DDL), root, KEY, CHECK, T2)   # repeated run
    assert sorted(map(str, again.collect())) == before


def test_named_empty_month_kept_or_purged(spark, lake):
    src = spark.createDataFrame([("2025-01", 1, dt.datetime(2025, 2, 1)), ("2025-02", 2, dt.datetime(2025, 3, 1))],
                                "source_month string, x int, loaded_at timestamp_ntz")
    incremental.build_incremental(spark, src, lake, full_refresh=True)
    only_jan = src.filter("source_month = '2025-01'")
    incremental.build_incremental(spark, only_jan, lake, months=["2025-01", "2025-02"])
    assert spark.read.parquet(lake).count() == 2                    # default: February keeps its rows
    incremental.build_incremental(spark, only_jan, lake, months=["2025-01", "2025-02"], purge_empty=True)
    got = sorted((str(r.source_month), r.x) for r in spark.read.parquet(lake).collect())
    assert got == [("2025-01", 1)]


def test_late_reload_of_another_input_triggers_its_months(spark):
    trips = spark.createDataFrame([("2025-01", dt.datetime(2025, 2, 1)), ("2025-02", dt.datetime(2025, 3, 1))],
                                  "source_month string, loaded_at timestamp_ntz")
    weather = spark.createDataFrame([("2025-01", dt.datetime(2025, 3, 15))], trips.schema)   # reloaded late
    target = trips                                                                          # fact is current
    assert incremental.changed_batches(trips, target).count() == 0
    got = [r[0] for r in incremental.changed_batches(trips, target, extra_sources=[weather]).collect()]
    assert got == ["2025-01"]


def test_lookup_csv_keeps_na_text(spark):
    from lakeshore.sources import lookups

    path = scratch_path(spark, "zones-csv-test")
    spark.createDataFrame([(264, "Unknown", "NV", "N/A"), (265, "N/A", "Outside of NYC", "N/A"), (1, "EWR", None, "EWR")],
                          lookups.ZONE_DDL).coalesce(1).write.option("header", True).csv(path)
    got = {r.location_id: r for r in lookups.read_lookup_csv(spark, path, lookups.ZONE_DDL).collect()}
    assert got[265].borough == "N/A" and got[264].service_zone == "N/A"     # text, not null
    assert got[1].zone is None                                              # an empty field is null

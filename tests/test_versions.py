"""Batches with a commit point, stopped at every step; footers instead of scans."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import incremental
from lakeshore.operators.rules import ReconcileError
from lakeshore.session import scratch_path
from lakeshore.sources import batches, versions

DDL = "year int, month int, layer string, x int"
BATCH, LAYER = ["year", "month"], ["layer"]


class Stopped(RuntimeError):
    pass


def rows_of(spark, tag, months=(1, 2)):
    """Both layers of some months; the tag tells which load a row is of."""
    return spark.createDataFrame([(2025, m, layer, tag * 10 + i) for m in months for layer in ("accepted", "quarantined")
                                  for i in range(2 + tag)], DDL)


def publish(spark, df, root, expected=lambda found: found):
    return versions.publish(spark, df, root, BATCH, expected, LAYER)


def held(spark, root, schema):
    got = {}
    for r in versions.read(spark, root, schema, BATCH).collect():
        got.setdefault((r.month, r.layer), set()).add(r.x)
    return got


def load(tag, months=(1, 2)):
    return {(m, layer): {tag * 10 + i for i in range(2 + tag)} for m in months for layer in ("accepted", "quarantined")}


def test_publish_read_replace_and_empty(spark):
    root = scratch_path(spark, "t-versions")
    first = rows_of(spark, 1)
    assert versions.read(spark, root, first.schema, BATCH).count() == 0
    counts = publish(spark, first, root)
    assert counts == {(2025, m, layer): 3 for m in (1, 2) for layer in ("accepted", "quarantined")}
    assert held(spark, root, first.schema) == load(1)
    publish(spark, rows_of(spark, 2, [2]).filter("layer = 'accepted'"), root)       # one batch, one layer left
    want = load(1, [1]) | {(2, "accepted"): {20, 21, 22, 23}}
    assert held(spark, root, first.schema) == want
    publish(spark, first.limit(0), root, lambda found: {(2025, 1): 0})              # a batch that lost all rows
    assert held(spark, root, first.schema) == {(2, "accepted"): {20, 21, 22, 23}}
    assert versions.vacuum(spark, root, first.schema, BATCH) >= 1
    assert held(spark, root, first.schema) == {(2, "accepted"): {20, 21, 22, 23}}


@pytest.mark.parametrize("step", ["write_version", "version_counts", "swap 0", "swap 1", "rename 0", "rename 1"])
def test_a_stop_anywhere_leaves_each_batch_old_or_new(spark, monkeypatch, step):
    root = scratch_path(spark, "t-stops")
    first = rows_of(spark, 1)
    publish(spark, first, root)
    what, _, at = step.partition(" ")
    calls = []

    def stopping(name, whole):
        def run(*a, **b):
            if name == what and (not at or len(calls) == int(at)):
                if name != "swap" or a[3]:      # the write has happened; the swap has not
                    if name == "write_version":
                        whole(*a, **b)
                    raise Stopped
            calls.append(name)
            return whole(*a, **b)
        return run

    if what == "rename":                        # the pointer's draft is written, its rename does not come
        files = versions._files

        def broken(spark_, path):
            if len(calls) == int(at):
                where, fs = files(spark_, path)
                draft = versions.partition_folder({"year": 2025})
                fs.create(spark_._jvm.org.apache.hadoop.fs.Path(f"{path}/.draft-{draft[:4]}"), True).close()
                raise Stopped
            calls.append(path)
            return files(spark_, path)
        monkeypatch.setattr(versions, "_files", broken)
    else:
        monkeypatch.setattr(versions, what, stopping(what, getattr(versions, what)))
    with pytest.raises(Stopped):
        publish(spark, rows_of(spark, 2), root)
    monkeypatch.undo()
    done = int(at) if at else 0
    assert held(spark, root, first.schema) == {k: v for m in (1, 2) for k, v in load(2 if m <= done else 1, [m]).items()}
    publish(spark, rows_of(spark, 2), root)     # run again
    assert held(spark, root, first.schema) == load(2)


def test_what_does_not_reconcile_is_not_seen(spark):
    root = scratch_path(spark, "t-differs")
    first = rows_of(spark, 1)
    publish(spark, first, root)
    with pytest.raises(ReconcileError):
        publish(spark, rows_of(spark, 2), root, lambda found: found | {(2025, 2): 99})
    assert held(spark, root, first.schema) == load(1)


def test_odd_batch_values(spark):
    root = scratch_path(spark, "t-odd")
    df = spark.createDataFrame([("a/b", 1), ("50%", 2), ("x y", 3), (None, 4), ("é=1", 5)], "k string, x int")
    counts = versions.publish(spark, df, root, ["k"], lambda found: found)
    assert counts == {("a/b",): 1, ("50%",): 1, ("x y",): 1, (None,): 1, ("é=1",): 1}
    got = {r.k: r.x for r in versions.read(spark, root, df.schema, ["k"]).collect()}
    assert got == {"a/b": 1, "50%": 2, "x y": 3, None: 4, "é=1": 5}


def test_input_is_evaluated_once(spark):
    from lakeshore.plans import standins
    from lakeshore.plans.pipelines import publish_clean, read_clean

    raw = standins.raw_trips(spark, "/root/testdata/sf0.001")
    seen = spark.sparkContext.accumulator(0)

    def count(batches_):
        for b in batches_:
            seen.add(b.num_rows)
            yield b

    root = scratch_path(spark, "t-once")
    report = publish_clean(spark, raw.mapInArrow(count, raw.schema), root, standins.STANDIN_TRIPS).collect()
    n = raw.count()
    assert seen.value == n == sum(r.input_rows for r in report) and all(r.reconciled for r in report)
    layers = {r[0]: r[1] for r in read_clean(spark, root, standins.STANDIN_TRIPS).groupBy("layer").count().collect()}
    assert layers == {"accepted": sum(r.accepted_rows for r in report), "quarantined": sum(r.quarantined_rows for r in report)}
    assert read_clean(spark, root, standins.STANDIN_TRIPS, "accepted").where("reject_reason IS NOT NULL").count() == 0


def test_rows_and_extremes_from_footers(spark):
    path = scratch_path(spark, "t-footers")
    day = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(i, float(i), day + dt.timedelta(hours=i) if i % 3 else None, f"s{i}") for i in range(30)],
                               "i bigint, d double, ts timestamp_ntz, s string")
    df.repartition(4).write.parquet(path)
    df.filter("i < 0").coalesce(1).write.mode("append").parquet(path)                   # a file without rows
    df.filter("i = 0").coalesce(1).write.mode("append").parquet(path)                   # and one of nulls
    assert batches.file_rows(spark, path).agg(F.sum("row_count")).first()[0] == 31
    want = {"i": (0, 29), "ts": (day + dt.timedelta(hours=1), day + dt.timedelta(hours=29)), "d": (0.0, 29.0), "s": ("s0", "s9")}
    for column, extremes in want.items():
        assert tuple(batches.stored_extremes(spark, path, column, df.schema).first()) == extremes, column
        known = batches.file_extremes(spark, column, df.schema[column].dataType.simpleString(), path).filter("known AND row_count > 0")
        assert (known.count() > 0) == (column in ("i", "ts"))
    # a file without the column is read for it, and has nothing to say
    df.drop("ts").limit(2).coalesce(1).write.mode("append").parquet(path)
    assert tuple(batches.stored_extremes(spark, path, "ts", df.schema).first()) == want["ts"]
    assert incremental.stored_high_water_mark(spark, path, df.schema, "ts").first()[0] == want["ts"][1]


def test_high_water_mark_of_a_table_without_rows(spark):
    path = scratch_path(spark, "t-no-mark")
    df = spark.createDataFrame([], "loaded_at timestamp_ntz")
    df.write.parquet(path)
    assert incremental.stored_high_water_mark(spark, path, df.schema).first()[0] == dt.datetime(1900, 1, 1)


def test_a_mixed_folder_is_read_by_its_files(spark):
    from lakeshore.operators.contract import Field

    base = scratch_path(spark, "t-mixed")
    spark.createDataFrame([(1, 2.5)], "id bigint, fee double").coalesce(1).write.parquet(f"{base}/period=1")
    spark.createDataFrame([(2,)], "id int").coalesce(1).write.mode("append").parquet(f"{base}/period=1")
    spark.createDataFrame([(3, 1.5), (4, 0.5)], "id bigint, fee double").repartition(2).write.parquet(f"{base}/period=2")
    folders = {p: f"{base}/period={p}" for p in "12"}
    shapes = batches.batch_shapes(batches.footer_schemas(spark, folders)).collect()
    assert sorted(r.path.rsplit("/", 1)[1].startswith("period=") for r in shapes) == [False, False, True]
    contract = [Field("id", "id", "bigint"), Field("fee", "fee", "double", default=0.0)]
    got = sorted(tuple(r) for r in batches.read_batches(spark, folders, contract).collect())
    assert got == [(1, 2.5, "1"), (2, 0.0, "1"), (3, 1.5, "2"), (4, 0.5, "2")]

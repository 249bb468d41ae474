"""What the batch queries shuffle: trips are joined once and arranged by batch while their rows are narrow."""
import os
import re

import pytest

from lakeshore.operators import incremental
from lakeshore.plans import landed, q_batches, standins
from lakeshore.sources import batches, versions

from conftest import rows

SF = "/root/testdata/sf0.001"


def reads(df) -> set[str]:
    """Names of the source tables whose files a frame reads."""
    return {name for f in df.inputFiles() for name in ("lineitem.parquet", "orders.parquet") if f.endswith(name)}


def seen_by(monkeypatch, module, name, at=1):
    """Calls of ``module.name`` are let through; the frames they are given."""
    frames, real = [], getattr(module, name)

    def call(*args, **kwargs):
        frames.append(args[at])
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, call)
    return frames


def test_arranged_trips_are_the_same_rows_one_file_a_batch(spark, tmp_path):
    plain, arranged = standins.raw_trips(spark, SF), standins.raw_trips(spark, SF, by_batch=True)
    assert arranged.dtypes == plain.dtypes and rows(arranged) == rows(plain)
    before = spark.conf.get(batches.OPEN_WRITERS)
    batches.write_batches(arranged, str(tmp_path / "lake"), files_per_batch=0)
    assert spark.conf.get(batches.OPEN_WRITERS) == before
    months = plain.select("year", "month").distinct().count()
    folders = [f for _, _, f in os.walk(tmp_path / "lake") if any(n.endswith(".parquet") for n in f)]
    assert len(folders) == months > batches.MOST_OPEN and all(sum(n.endswith(".parquet") for n in f) == 1 for f in folders)
    assert rows(spark.read.parquet(str(tmp_path / "lake")).select(plain.columns)) == rows(plain)


@pytest.mark.parametrize("unit", [0, None])
def test_writes_as_they_are_need_no_order(spark, tmp_path, unit):
    # every task has rows of all of more batches than files are kept open for
    df = spark.range(0, 1000, 1, 3).selectExpr("id", "id % 100 AS k")
    batches.write_batches(df, str(tmp_path), ["k"], files_per_batch=unit)
    assert rows(spark.read.parquet(str(tmp_path)).selectExpr("id", "CAST(k AS bigint) AS k")) == rows(df)


def test_fact_incremental_builds_on_stored_silver(spark, monkeypatch):
    frames = seen_by(monkeypatch, incremental, "build_incremental")
    q_batches.q_fact_incremental(spark, SF)
    assert len(frames) == 2 and not any(reads(f) for f in frames)


def test_replace_batch_reloads_from_the_bronze_lake(spark, monkeypatch):
    built, reloaded = seen_by(monkeypatch, batches, "write_batches", 0), seen_by(monkeypatch, batches, "replace_batches")
    q_batches.q_replace_batch(spark, SF)
    assert reads(built[0]) == {"lineitem.parquet", "orders.parquet"}              # the bronze lake, once
    assert not any(reads(f) for f in [*built[1:], *reloaded])
    scan = re.search(r"PartitionFilters: \[[^]]*", reloaded[0]._jdf.queryExecution().toString()).group()
    assert "= 1997" in scan and "= 5" in scan                                     # and of it the month's folder alone


def test_schema_append_builds_on_stored_silver(spark, monkeypatch):
    frames = seen_by(monkeypatch, incremental, "build_incremental")
    q_batches.q_schema_append(spark, SF)
    assert len(frames) == 2 and not any(reads(f) for f in frames)


def test_schema_registered_builds_on_stored_silver(spark, monkeypatch):
    frames = seen_by(monkeypatch, incremental, "build_incremental")
    q_batches.q_schema_registered(spark, SF)
    assert len(frames) == 2 and not any(reads(f) for f in frames)


def test_landing_shuffles_no_rows_of_files_that_lie_by_batch(spark, monkeypatch):
    written, units, real = seen_by(monkeypatch, batches, "write_batches", 0), [], versions.write_version

    def write(df, root, batch_cols, layer=(), files_per_batch=None):
        units.append((list(layer), files_per_batch))
        return real(df, root, batch_cols, layer, files_per_batch)

    monkeypatch.setattr(versions, "write_version", write)
    q_batches.q_landing_republished(spark, SF)
    assert [unit for layer, unit in units if layer] == [0, 0]                     # both runs
    assert reads(written[0]) and not any(reads(f) for f in written[1:])           # trips are joined once


def test_many_small_landed_files_are_gathered(spark):
    p = standins.STANDIN_TRIPS
    of = lambda n, size: spark.createDataFrame([(f"f{i}", size, None, 2024, i % 2) for i in range(n)], landed.ledger_schema(p))
    assert landed.lies_by_batch(of(16, 100), p) and landed.lies_by_batch(of(400, 64 << 20), p)
    assert not landed.lies_by_batch(of(400, 1000), p)

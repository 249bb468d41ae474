"""Landing keyed by path and stamp: a file republished under the same name replaces its rows, once."""
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeshore.plans import landed, standins
from lakeshore.plans.pipelines import read_clean
from lakeshore.session import scratch_path
from lakeshore.sources import batches, versions

SF = "/root/testdata/sf0.001"
P = standins.STANDIN_TRIPS


@pytest.fixture(scope="module")
def raw(spark):
    from lakeshore.session import materialize

    return materialize(spark, standins.raw_trips(spark, SF).where("year = 1997 AND month <= 3"), "t-raw")


def _lake(spark, raw):
    lake = scratch_path(spark, "t-bronze-landed")
    batches.write_batches(raw, lake, files_per_batch=1)
    return lake, scratch_path(spark, "t-landed"), scratch_path(spark, "t-ledger")


def _files(lake, month):
    folder = f"{lake}/year=1997/month={month}"
    return [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")]


def _rewrite(lake, month, keep):
    """Other content under the same file name."""
    import pyarrow.parquet as pq

    (path,) = _files(lake, month)
    pq.write_table(pq.read_table(path).slice(0, keep), path)
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def _per_month(df):
    return {tuple(r) for r in df.groupBy("month").agg(F.count(F.lit(1))).collect()}


def test_republished_gone_and_new_files(spark, raw):
    lake, target, ledger = _lake(spark, raw)
    first = landed.land_changed(spark, lake, target, ledger, P)
    assert first.count() == 3 and all(r.reconciled for r in first.collect())
    assert _per_month(read_clean(spark, target, P)) == _per_month(raw)
    held = {tuple(r.values()) for r in versions.pointers(spark, target, landed.ledger_schema(P), P.batch_cols)}

    assert landed.land_changed(spark, lake, target, ledger, P).count() == 0             # nothing changed: nothing read
    assert {tuple(r.values()) for r in versions.pointers(spark, target, landed.ledger_schema(P), P.batch_cols)} == held

    _rewrite(lake, 2, 10)
    again = rows(landed.land_changed(spark, lake, target, ledger, P), "year", "month", "input_rows")
    assert again == [(1997, 2, 10)]
    expected = {(m, 10 if m == 2 else n) for m, n in _per_month(raw)}
    assert _per_month(read_clean(spark, target, P)) == expected
    assert landed.land_changed(spark, lake, target, ledger, P).count() == 0

    for path in _files(lake, 3):                                                        # a batch is taken back
        os.remove(path)
    assert rows(landed.land_changed(spark, lake, target, ledger, P), "month", "input_rows") == [(3, 0)]
    assert _per_month(read_clean(spark, target, P)) == {x for x in expected if x[0] != 3}
    batches.write_batches(raw.where("month = 3"), lake)                                 # and lands again
    assert landed.land_changed(spark, lake, target, ledger, P).count() == 1
    assert _per_month(read_clean(spark, target, P)) == expected


def test_a_run_stopped_before_the_ledger_is_repeated(spark, raw, monkeypatch):
    lake, target, ledger = _lake(spark, raw)
    real = versions.publish

    def stop(spark_, df, root, *args, **kw):
        if root == ledger:
            raise RuntimeError("stopped")
        return real(spark_, df, root, *args, **kw)

    monkeypatch.setattr(versions, "publish", stop)
    with pytest.raises(RuntimeError):
        landed.land_changed(spark, lake, target, ledger, P)
    monkeypatch.setattr(versions, "publish", real)
    assert landed.land_changed(spark, lake, target, ledger, P).count() == 3              # once more, and no row twice
    assert _per_month(read_clean(spark, target, P)) == _per_month(raw)


def test_missing_and_empty_bronze(spark):
    where = [scratch_path(spark, f"t-none-{i}") for i in range(3)]
    assert landed.land_changed(spark, *where, P).count() == 0
    assert read_clean(spark, where[1], P).count() == 0

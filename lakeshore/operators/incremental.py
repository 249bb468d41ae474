"""Incremental builds keyed by a batch column: full build, rebuild named batches, rebuild
batches with rows newer than the target's high-water mark (delete + insert per batch)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.sources import fields
from lakeshore.sources.batches import batch_counts, exists, replace_batches, spread, stored_extremes, unsorted_writes

EPOCH_MARK = "1900-01-01 00:00:00"


def high_water_mark(target: DataFrame, mark: str = "loaded_at") -> DataFrame:
    """One row: the target's newest mark, or 1900-01-01 when the target is empty."""
    return target.agg(F.coalesce(F.max(mark), F.lit(EPOCH_MARK).cast("timestamp_ntz")).alias("hwm"))


def stored_high_water_mark(spark: SparkSession, path: str, schema, mark: str = "loaded_at") -> DataFrame:
    """:func:`high_water_mark` of a stored table, from the footers of its files: the column is read only of
    files whose statistics do not tell."""
    return stored_extremes(spark, path, mark, schema).select(
        F.coalesce(F.col("high"), F.lit(EPOCH_MARK).cast("timestamp_ntz")).alias("hwm"))


def changed_batches(source: DataFrame, target: DataFrame, key: str = "source_month", mark: str = "loaded_at",
                    extra_sources: Sequence[DataFrame] = (), hwm: DataFrame | None = None) -> DataFrame:
    """Distinct batch keys having a row with ``mark`` strictly after the target's high-water
    mark. ``extra_sources`` (same ``key``/``mark`` columns) let a late reload of another input
    (weather, holidays) trigger its batches too. A one-row scalar (``hwm``, or the target's) joined to the rows."""
    hwm = high_water_mark(target, mark) if hwm is None else hwm
    frames = [source.select(key, mark)] + [s.select(key, mark) for s in extra_sources]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    return rows.crossJoin(F.broadcast(hwm)).filter(F.col(mark) > F.col("hwm")).select(key).distinct()


def build_incremental(spark: SparkSession, source: DataFrame, target_path: str, key: str = "source_month",
                      months: Sequence[str] | str | None = None, full_refresh: bool = False,
                      mark: str = "loaded_at", files_per_batch: int | None = None,
                      purge_empty: bool = False, extra_sources: Sequence[DataFrame] = ()) -> dict[tuple, int]:
    """Write ``source`` into ``target_path`` partitioned by ``key``:

    - ``full_refresh`` or no target yet: the whole table is replaced, batches that the source no
      longer has included;
    - ``months`` given (one or a list): only those batches are read and replaced;
    - otherwise: the batches with rows newer than the target's high-water mark, in ``source`` or in
      ``extra_sources`` (late reloads of other inputs).
    Replacing is per batch present in the new rows (delete + insert); a named batch with no
    new rows keeps its old rows unless ``purge_empty`` (then it is emptied). The batch list is
    a handful of keys and is collected, so the source filter becomes a literal IN list the
    scan can prune with. Columns are registered beside the table (:mod:`lakeshore.sources.fields`); one that
    changes its type raises."""
    if full_refresh or not exists(spark, target_path):
        with unsorted_writes(spark, files_per_batch):
            (spread(source, [key], files_per_batch).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy(key).parquet(target_path))
        fields.record(spark, target_path, source.schema, replace=True)
        return {}
    if months is not None:
        wanted = [months] if isinstance(months, str) else list(months)
    else:
        target = fields.read(spark, target_path)
        hwm = stored_high_water_mark(spark, target_path, target.schema, mark)
        wanted = [r[0] for r in changed_batches(source, target, key, mark, extra_sources, hwm).collect()]
    if not wanted:
        return {}
    rows = source.filter(F.col(key).isin(wanted))
    expected = batch_counts(rows, [key])
    if months is None or purge_empty:
        expected = {(w,): 0 for w in wanted} | expected      # a batch that lost all its rows is emptied
    fields.record(spark, target_path, source.schema, since=str(min(map(str, wanted))))
    return replace_batches(spark, rows, target_path, [key], files_per_batch, expected=expected)

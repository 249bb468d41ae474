"""Incremental landing of batch files with Structured Streaming.

A file-source stream over the bronze folders picks up every file exactly once (the
stream's checkpoint remembers processed files: a landed batch is never cleaned twice);
``trigger(availableNow=True)`` processes what is there and stops, which makes it a
scheduled batch job with exactly-once bookkeeping. Each micro-batch is cleaned once and written
once, partitioned by (layer, batch columns, micro-batch id) with dynamic overwrite, so a micro-batch
retried after a failure rewrites the same partitions instead of appending duplicates.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EPOCH_COL = "landing_epoch"
LAYER_COL = "layer"


def clean_landed_files(spark: SparkSession, bronze_root: str, schema, clean: Callable[[DataFrame], DataFrame],
                       target: str, checkpoint: str, batch_cols: tuple[str, ...] = ("year", "month"),
                       max_files_per_trigger: int | None = None, reason_col: str = "reject_reason") -> StreamingQuery:
    """Start (and return) the landing stream; ``schema`` must include the folder columns.
    ``clean`` maps raw rows to rows with a reason column (for example ``clean_trips``). Accepted rows
    go to ``<target>/layer=accepted``, the others to ``<target>/layer=quarantined``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(bronze_root)
    parts = [LAYER_COL, *batch_cols, EPOCH_COL]

    def land(batch: DataFrame, epoch_id: int) -> None:
        layer = F.when(F.col(reason_col).isNull(), "accepted").otherwise("quarantined")
        (clean(batch).withColumns({EPOCH_COL: F.lit(epoch_id), LAYER_COL: layer}).hint("rebalance", *parts)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(target))

    return (stream.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for the stream's end; one that has not ended in time is stopped and reported as unfinished."""
    if query.awaitTermination(timeout_s) is False:
        query.stop()
        raise TimeoutError(f"landing not finished after {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()

"""Landing that notices republished files. The file stream of :mod:`lakeshore.streaming.landing` tells files by their
path alone, so a month published again under the same name passes it by. Here the state of what was landed is kept by
path *and* size and modification time: a batch with a file that is new, changed or gone is cleaned again, and its rows
replaced at one commit point (:mod:`lakeshore.sources.versions`).

The listing is stored first, then the batches are published, then their ledger rows. A run that stops in between publishes
the same batches again; a file that changes while a run reads it is listed with its old stamp and seen by the next
run. (A file rewritten with equal size and equal time is not told apart.)
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from lakeshore.plans.pipelines import publish_clean
from lakeshore.plans.trips import TAXI, TripParams
from lakeshore.session import materialize
from lakeshore.sources import batches, versions
from lakeshore.sources.batches import folder_value

STAMP_DDL = "path string, bytes bigint, modified timestamp"

# Batches of few files, or of files of some size, are cleaned and written file by file; smaller ones are gathered first.
FEW_FILES, SIZED_FILE = 8, 8 << 20


def ledger_schema(p: TripParams = TAXI) -> StructType:
    """One row per landed file: its path and stamp, and its batch."""
    schema = StructType.fromDDL(STAMP_DDL)
    for c in p.batch_cols:
        schema = schema.add(c, IntegerType())
    return schema


def listed(spark: SparkSession, bronze: str, p: TripParams = TAXI) -> DataFrame:
    """The files below ``bronze`` as ledger rows, from a listing that opens none; empty where the folder is missing."""
    if not batches.exists(spark, bronze):
        return spark.createDataFrame([], ledger_schema(p))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(bronze)
             .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")))
    return files.select("*", *[folder_value(F.col("path"), c).cast("int").alias(c) for c in p.batch_cols])


def changed_batches(now: DataFrame, before: DataFrame, p: TripParams = TAXI) -> DataFrame:
    """(batch, files): batches with a file whose stamp differs from the ledger's, and how many files they have now (0:
    the batch is gone). One row per changed batch."""
    stamp = ["path", "bytes", "modified"]
    both = now.withColumn("__now", F.lit(1)).unionByName(before.withColumn("__now", F.lit(-1)))
    files = both.groupBy(*p.batch_cols, *stamp).agg(F.sum("__now").alias("side"))     # 0: in both, as it was
    return (files.groupBy(*p.batch_cols).agg(F.count_if(F.col("side") != 0).alias("differing"), F.count_if(F.col("side") >= 0).alias("files"))
            .filter("differing > 0").drop("differing"))


def lies_by_batch(files: DataFrame, p: TripParams = TAXI) -> bool:
    """Whether landed files (ledger rows) can be written as they are read, without a shuffle: a file has rows of one batch,
    and writing makes no more files of a batch and layer than were read."""
    n, size, of = files.agg(F.count(F.lit(1)), F.sum("bytes"), F.count_distinct(F.struct(*p.batch_cols))).first()
    return n <= FEW_FILES * of or size >= SIZED_FILE * n


def land_changed(spark: SparkSession, bronze: str, target: str, ledger: str, p: TripParams = TAXI) -> DataFrame:
    """One landing run: the reconciliation of every batch that was published (or emptied: no rows) in it. Read the layers
    with :func:`lakeshore.plans.pipelines.read_clean`. Files of batches that did not change are listed, not read."""
    cols = list(p.batch_cols)
    now = materialize(spark, listed(spark, bronze, p), "landing-listing")
    before = versions.read(spark, ledger, ledger_schema(p), cols)
    changed = materialize(spark, changed_batches(now, before, p), "landing-changed")
    gone = [tuple(r) for r in changed.filter("files = 0").select(*cols).collect()]
    stale = batches.same_batches(now, changed.filter("files > 0"), cols)
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    folders = {"/".join(map(str, r[:-1])): r[-1] for r in stale.select(*cols, folder).distinct().collect()}

    report = spark.createDataFrame([(*b, 0, 0, 0, True) for b in gone], _report_schema(p))
    if folders:
        rows = batches.read_batches(spark, folders, p.contract, base_path=bronze, keep=cols).drop("period")
        at = [folder_value(F.col("file"), c).cast("int").alias(c) for c in cols]
        landed = batches.file_rows(spark, *folders.values()).groupBy(*at).agg(F.sum("row_count")).collect()
        report = report.unionByName(publish_clean(spark, rows, target, p, conformed=True, expected={tuple(r[:-1]): r[-1] for r in landed},
                                                  files_per_batch=0 if lies_by_batch(stale, p) else None))
    for b in gone:
        versions.swap(spark, target, dict(zip(cols, b, strict=True)), None, 0)
    if folders:
        versions.publish(spark, stale, ledger, cols, lambda written: written)
    for b in gone:
        versions.swap(spark, ledger, dict(zip(cols, b, strict=True)), None, 0)
    return report


def _report_schema(p: TripParams) -> StructType:
    schema = StructType()
    for c in p.batch_cols:
        schema = schema.add(c, IntegerType())
    for c in ("input_rows", "accepted_rows", "quarantined_rows"):
        schema = schema.add(c, "long")
    return schema.add("reconciled", "boolean")

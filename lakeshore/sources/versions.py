"""Batches with a commit point: rows of a batch lie in a folder of their own version, and a pointer file per
batch names the version that holds.

    <root>/data/version=<id>/<batch folders>/<layer folder>/part-...      written first, seen by nobody
    <root>/current/<batch folders>/pointer.json                          swapped last, by one rename

A reader follows the pointers, so it sees a batch as it was or as it is, all layers alike, wherever a
publishing job stops. A stopped job leaves a version that no pointer names; it is harmless, and
:func:`vacuum` deletes it. Publishing again is safe: it writes a new version and swaps again.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeshore.operators.rules import ReconcileError
from lakeshore.sources.batches import _differences, exists, file_rows, partition_folder, spread, unsorted_writes

VERSION_COL = "version"


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_version(df: DataFrame, root: str, batch_cols: Sequence[str], layer: Sequence[str] = (),
                  files_per_batch: int | None = None) -> str:
    """Write the rows as a new version that no pointer names yet; its id."""
    version = uuid.uuid4().hex
    parts = [*batch_cols, *layer]
    with unsorted_writes(df.sparkSession, files_per_batch):
        (spread(df, parts, files_per_batch).write.mode("error").option("partitionOverwriteMode", "static")
         .partitionBy(*parts).parquet(f"{root.rstrip('/')}/data/{VERSION_COL}={version}"))
    return version


def version_counts(spark: SparkSession, root: str, version: str, schema: StructType, batch_cols: Sequence[str],
                   layer: Sequence[str] = ()) -> dict[tuple, int]:
    """Rows of a version per (batch, layer), from the footers of its files: one small row per folder."""
    parts = [*batch_cols, *layer]
    path = f"{root.rstrip('/')}/data/{VERSION_COL}={version}"
    if not exists(spark, path):
        return {}
    rows = file_rows(spark, path).withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
    per_folder = rows.groupBy("folder").agg(F.sum("row_count").alias("n")).collect()
    # folder names become values of the columns' own types the way a partitioned read does it
    types = {f.name: f.dataType for f in schema.fields}
    names = spark.createDataFrame([(*_values(r.folder, parts), r.n) for r in per_folder],
                                  StructType([*[StructField(c, StringType()) for c in parts]]).add("n", "long"))
    return {tuple(r[:-1]): r[-1] for r in names.select(*[F.col(c).cast(types[c]).alias(c) for c in parts], "n").collect()}


def _values(folder: str, parts: Sequence[str]) -> list[str | None]:
    from urllib.parse import unquote

    named = dict(p.split("=", 1) for p in folder.split("/") if "=" in p)
    value = {k: unquote(v) for k, v in named.items()}
    return [None if value[c] == "__HIVE_DEFAULT_PARTITION__" else value[c] for c in parts]


def swap(spark: SparkSession, root: str, batch: dict, version: str | None, rows: int) -> None:
    """Point a batch to a version (None: the batch is empty): the commit point, one rename that replaces."""
    where = f"{root.rstrip('/')}/current/{partition_folder(batch)}"
    folder, fs = _files(spark, where)
    fs.mkdirs(folder)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    draft = jvm.org.apache.hadoop.fs.Path(f"{where}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({VERSION_COL: version, "rows": rows}).encode()))
    out.close()
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    replace = gateway.new_array(kinds, 1)
    replace[0] = kinds.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    qualified = [fs.makeQualified(p) for p in (draft, jvm.org.apache.hadoop.fs.Path(f"{where}/pointer.json"))]
    context.rename(*qualified, replace)


def pointers(spark: SparkSession, root: str, schema: StructType, batch_cols: Sequence[str]) -> list[dict]:
    """The pointer of every batch: one small row each."""
    where = f"{root.rstrip('/')}/current"
    if not exists(spark, where):
        return []
    ddl = StructType([StructField(VERSION_COL, StringType())]).add("rows", "long")
    for c in batch_cols:
        ddl = ddl.add(schema[c])
    return [r.asDict() for r in spark.read.schema(ddl).option("pathGlobFilter", "pointer.json").json(where).collect()]


def read(spark: SparkSession, root: str, schema: StructType, batch_cols: Sequence[str]) -> DataFrame:
    """The rows of every batch's version; ``schema`` has the batch and layer columns. Only folders that hold are listed."""
    data = f"{root.rstrip('/')}/data"
    paths = [f"{data}/{VERSION_COL}={p[VERSION_COL]}/{partition_folder({c: p[c] for c in batch_cols})}"
             for p in pointers(spark, root, schema, batch_cols) if p[VERSION_COL]]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", data).parquet(*paths).select(*schema.names)


def publish(spark: SparkSession, df: DataFrame, root: str, batch_cols: Sequence[str], expected, layer: Sequence[str] = (),
            files_per_batch: int | None = None) -> dict[tuple, int]:
    """Replace batches by the rows of ``df``, computed once, in the write itself:

    1. write a new version;
    2. count its rows from the footers, and hand the counts per batch to ``expected``, which returns the rows per
       batch that must be there, or raises; a difference raises :class:`ReconcileError`, and nothing is seen of it;
    3. swap the pointers, batch by batch; an expected batch without rows is emptied.

    Returns the counts per (batch, layer)."""
    version = write_version(df, root, batch_cols, layer, files_per_batch)
    found = version_counts(spark, root, version, df.schema, batch_cols, layer)
    per_batch: dict[tuple, int] = {}
    for key, n in found.items():
        per_batch[key[:len(batch_cols)]] = per_batch.get(key[:len(batch_cols)], 0) + n
    wanted = expected(per_batch)
    held = {k: n for k, n in per_batch.items() if n}
    if held != {k: n for k, n in wanted.items() if n}:
        raise ReconcileError(f"{root}: not published; expected and written rows differ: {_differences(wanted, held)}")
    for key in sorted(wanted, key=repr):
        n = held.get(key, 0)
        swap(spark, root, dict(zip(batch_cols, key, strict=True)), version if n else None, n)
    return found


def vacuum(spark: SparkSession, root: str, schema: StructType, batch_cols: Sequence[str]) -> int:
    """Delete the versions that no pointer names: for times when no job reads or publishes. Their number."""
    live = {p[VERSION_COL] for p in pointers(spark, root, schema, batch_cols)}
    where, fs = _files(spark, f"{root.rstrip('/')}/data")
    if not fs.exists(where):
        return 0
    gone = 0
    for found in fs.listStatus(where):
        name = found.getPath().getName()
        if name.startswith(f"{VERSION_COL}=") and name.split("=", 1)[1] not in live:
            fs.delete(found.getPath(), True)
            gone += 1
    return gone

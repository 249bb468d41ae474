"""Batch-partitioned lake folders (``<root>/year=YYYY/month=M/…``): writing, replacing one or
many batches, reading across drifting file schemas, footer schemas and file manifests.

Folder columns are discovered as ints on read and a filter on them prunes folders before
any file is opened (``PartitionFilters`` in the plan).
"""
from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators.contract import Field, conform
from lakeshore.operators.rules import ReconcileError
from lakeshore.session import scratch_path


def spread(df: DataFrame, batch_cols: Sequence[str], files_per_batch: int | None = None) -> DataFrame:
    """Arrange rows before a partitioned write so a batch folder gets a few right-sized files
    instead of one small file per (task, batch):

    - ``None`` (default): a rebalance on the batch columns; adaptive execution sizes the output
      partitions to the advisory partition size and splits a skewed batch (one month holding
      a third of the rows) over several tasks;
    - ``0``: write the upstream partitions as they are (no shuffle), for inputs that are
      already clustered by batch;
    - ``n``: up to ``n`` tasks per batch, split by a deterministic row hash (adaptive execution
      may still merge partitions that are small)."""
    if files_per_batch is None:
        return df.hint("rebalance", *batch_cols)
    if files_per_batch == 0:
        return df
    if files_per_batch == 1:
        return df.repartition(*batch_cols)
    salt = F.pmod(F.hash(*df.columns), F.lit(files_per_batch))
    return df.repartition(*batch_cols, salt)


OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
MOST_OPEN = 64                  # a scan task packs at most 32 files; twice that for two layers


@contextmanager
def unsorted_writes(spark: SparkSession, files_per_batch: int | None) -> Iterator[None]:
    """For rows written as they are (``files_per_batch`` 0): a task keeps a file open per batch instead of sorting its
    rows by batch, which spills once a task's wide rows outgrow its memory. Beyond ``MOST_OPEN`` batches it sorts."""
    if files_per_batch != 0:
        yield
        return
    before = spark.conf.get(OPEN_WRITERS)
    spark.conf.set(OPEN_WRITERS, str(MOST_OPEN))
    try:
        yield
    finally:
        spark.conf.set(OPEN_WRITERS, before)


def write_batches(df: DataFrame, path: str, batch_cols: Sequence[str] = ("year", "month"),
                  files_per_batch: int | None = None, mode: str = "overwrite",
                  sort_by: Sequence[str] = ()) -> None:
    """Partitioned Parquet write. With the session's dynamic partition-overwrite mode an
    overwrite replaces exactly the batches present in ``df`` and leaves the others.
    ``sort_by`` orders rows inside each task (no global sort, no extra shuffle), which keeps
    Parquet min/max statistics tight so later range filters skip row groups."""
    out = spread(df, batch_cols, files_per_batch)
    if sort_by:
        out = out.sortWithinPartitions(*batch_cols, *sort_by)
    with unsorted_writes(df.sparkSession, None if sort_by else files_per_batch):
        (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(*batch_cols).parquet(path))


def batch_counts(df: DataFrame, batch_cols: Sequence[str]) -> dict[tuple, int]:
    """Rows per batch; the result has one small row per batch (metadata-sized)."""
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*batch_cols).count().collect()}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table is at ``path``: a folder holding a file that is no marker. Anything that keeps this
    from being told (permission, network) is an error, never "no"."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return False
    files = fs.listFiles(where, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


_PATH_ESCAPES = {c: f"%{ord(c):02X}" for c in '"#%\'*/:=?\\{[]^'}


def partition_folder(values: dict) -> str:
    """``key=value/...`` as Spark names it (escaped; null has a name of its own)."""
    text = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else "".join(_PATH_ESCAPES.get(c, c) for c in str(v))
    return "/".join(f"{k}={text(v)}" for k, v in values.items())


def purge_partitions(spark: SparkSession, target: str, partitions: Sequence[dict]) -> None:
    """Empty the given partitions of a stored table: each folder is replaced by an empty result, so
    readers see no rows for it; other partitions are untouched."""
    if not partitions:
        return
    empty = spark.read.parquet(target).drop(*partitions[0]).where(F.lit(False))
    view = f"__empty_{uuid.uuid4().hex}"
    empty.createOrReplaceTempView(view)
    for values in partitions:
        folder = f"{target.rstrip('/')}/{partition_folder(values)}".replace("'", "\\'")
        spark.sql(f"INSERT OVERWRITE DIRECTORY '{folder}' USING parquet SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


def same_batches(df: DataFrame, batches: DataFrame, batch_cols: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose batch (null included) is one of ``batches`` (one small row per batch)."""
    b = batches.select(*[F.col(c).alias(f"__b_{c}") for c in batch_cols]).distinct()
    on = F.lit(True)
    for c in batch_cols:
        on = on & F.col(c).eqNullSafe(F.col(f"__b_{c}"))
    return df.join(b, on, "left_semi")


def _differences(a: dict, b: dict) -> str:
    wrong = [k for k in a.keys() | b.keys() if a.get(k) != b.get(k)]
    shown = {k: (a.get(k, 0), b.get(k, 0)) for k in sorted(wrong, key=repr)[:5]}
    return f"{shown}{' ...' if len(wrong) > 5 else ''}"


def publish(spark: SparkSession, staged: DataFrame, target: str, batch_cols: Sequence[str],
            expected: dict[tuple, int], layer: Sequence[str] = (), files_per_batch: int | None = None) -> dict[tuple, int]:
    """Replace, in ``target`` (partitioned by ``layer`` and ``batch_cols``), the batches of ``expected`` by the
    ``staged`` rows. Staged counts are compared with the expected ones first; on a difference nothing is
    published. A partition of these batches that has no staged rows is emptied."""
    counts = {k: n for k, n in batch_counts(staged, batch_cols).items() if n}
    wanted = {k: n for k, n in expected.items() if n}
    if counts != wanted:
        raise ReconcileError(f"{target}: not published; expected and staged rows differ: {_differences(wanted, counts)}")
    parts = [*layer, *batch_cols]

    def held() -> DataFrame:        # with the types of the staged rows: folder names would be guessed anew
        return spark.read.schema(staged.schema).parquet(target)

    batches = spark.createDataFrame([tuple(k) for k in expected], staged.select(*batch_cols).schema) if expected else None
    old = []
    if batches is not None and exists(spark, target):
        old = same_batches(held(), batches, batch_cols).select(*parts).distinct().collect()
    write_batches(staged, target, parts, files_per_batch)
    new = {tuple(r) for r in staged.select(*parts).distinct().collect()}
    purge_partitions(spark, target, [dict(zip(parts, r, strict=True)) for r in map(tuple, old) if r not in new])
    if batches is not None:
        found = {k: n for k, n in batch_counts(same_batches(held(), batches, batch_cols), batch_cols).items() if n}
        if found != wanted:
            raise ReconcileError(f"{target}: staged and published rows differ: {_differences(wanted, found)}")
    return counts


def replace_batches(spark: SparkSession, df: DataFrame, target: str, batch_cols: Sequence[str] = ("year", "month"),
                    files_per_batch: int | None = None, stage: str | None = None,
                    expected: dict[tuple, int] | None = None) -> dict[tuple, int]:
    """Replace the batches present in ``df`` inside ``target``:

    1. count the rows per batch that must arrive: ``expected``, as the source reports them, or a
       count of ``df`` by itself;
    2. write ``df`` to a staging folder in the shared scratch area;
    3. compare; a difference raises :class:`ReconcileError` and leaves ``target`` as it was;
    4. publish by a dynamic overwrite of those batches, and compare what can be read back.
    Batches not in ``df`` are untouched; a batch expected with 0 rows is emptied. Returns rows per
    published batch."""
    if expected is None:
        expected = batch_counts(df, batch_cols)
    stage = stage or scratch_path(spark, "stage")
    write_batches(df, stage, batch_cols, files_per_batch)
    staged = spark.read.schema(df.schema).parquet(stage)
    return publish(spark, staged, target, batch_cols, expected, files_per_batch=files_per_batch)


def read_leaf(spark: SparkSession, root: str, **batch: int | str) -> DataFrame:
    """One batch folder read on its own: the folder columns are *not* columns of the result."""
    leaf = "/".join(f"{k}={v}" for k, v in batch.items())
    return spark.read.parquet(f"{root.rstrip('/')}/{leaf}")


def read_root(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """All batches; folder names become typed columns (``month=05`` -> int 5)."""
    return spark.read.option("mergeSchema", merge_schema).parquet(root)


def data_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``file, folder`` of every Parquet file below the paths, from a listing that opens none."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.parquet").load(list(paths)).select(F.col("path").alias("file")))
    return listed.withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))


def leaf_folders(spark: SparkSession, root: str) -> list[str]:
    """Batch folders under ``root`` (one row per folder reaches the driver, not one per file)."""
    return sorted(r.folder for r in data_files(spark, root).select("folder").distinct().collect())


def _same_path(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


FOOTER_ROWS = "file string, column string, type string, position int"
ROW_COUNTS = "file string, row_count bigint"


def _from_footers(files: DataFrame, rows_of, ddl: str) -> DataFrame:
    """One distributed job over the files of column ``file`` that reads footers only: ``rows_of(uri, footer)`` gives
    rows of ``ddl``. (Both travel with the tasks: executors need not have this package.)"""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        import re

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for uri in batch.column(0).to_pylist():
                # listed paths are not escaped as URIs are: only scheme and host are taken for one
                scheme, host, path = re.fullmatch(r"(?:(\w[\w+.-]*):)?(?://([^/]*))?(/.*)", uri).groups()
                if scheme in (None, "file"):
                    where, base = fs.LocalFileSystem(), ""
                else:
                    where, base = fs.FileSystem.from_uri(f"{scheme}://{host or ''}/")
                with where.open_input_file(base.rstrip("/") + path) as f:
                    rows += rows_of(uri, pq.ParquetFile(f).metadata)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)],
                                                 schema=fields)

    return files.select("file").repartition("file").mapInArrow(run, ddl)


def file_footers(files: DataFrame) -> DataFrame:
    """(file, column, type, position) from the footer of every file of column ``file``. Types are Spark's names."""
    def columns(uri, footer):
        from pyspark.sql.pandas.types import from_arrow_schema

        schema = from_arrow_schema(footer.schema.to_arrow_schema(), prefer_timestamp_ntz=True)
        return [(uri, f.name, f.dataType.simpleString(), i) for i, f in enumerate(schema)]

    return _from_footers(files, columns, FOOTER_ROWS)


def file_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, row_count) of every Parquet file below the paths, from its footer: no column is read."""
    return _from_footers(data_files(spark, *paths), lambda uri, footer: [(uri, footer.num_rows)], ROW_COUNTS)


#: Types whose row-group statistics are the exact extremes (text may be cut, floating point may hide NaN).
EXACT_STATISTICS = ("tinyint", "smallint", "int", "bigint", "date", "timestamp_ntz", "timestamp")


def file_extremes(spark: SparkSession, column: str, kind: str, *paths: str) -> DataFrame:
    """(file, row_count, known, low, high) of ``column`` (of type ``kind``) in every file, from row-group statistics:
    ``known`` is false where a row group with rows lacks them or the column is not in the file, true (and the extremes
    null) where all values are null."""
    def extremes(uri, footer):
        names = footer.schema.to_arrow_schema().names
        if kind not in EXACT_STATISTICS or column not in names:
            return [(uri, footer.num_rows, False, None, None)]
        found, known, at = [], True, [footer.schema.column(i).path for i in range(len(footer.schema))].index(column)
        for g in range(footer.num_row_groups):
            group = footer.row_group(g)
            stats = group.column(at).statistics
            if stats is not None and stats.has_min_max:
                found += [stats.min, stats.max]
            elif group.num_rows and not (stats is not None and stats.has_null_count and stats.null_count == group.num_rows):
                known = False
        return [(uri, footer.num_rows, known, min(found, default=None) if known else None, max(found, default=None) if known else None)]

    return _from_footers(data_files(spark, *paths), extremes, f"{ROW_COUNTS}, known boolean, low {kind}, high {kind}")


def stored_extremes(spark: SparkSession, path: str, column: str, schema) -> DataFrame:
    """One row ``low, high`` of a stored table's column: from footers, and by reading the column of only
    those files whose statistics do not tell."""
    kind = schema[column].dataType.simpleString()
    stats = file_extremes(spark, column, kind, path)
    told = stats.filter("known").select("low", "high")
    unknown = [r.file for r in stats.filter("NOT known AND row_count > 0").select("file").collect()]
    if unknown:
        read = spark.read.schema(schema).option("basePath", path).parquet(*unknown)
        told = told.unionByName(read.select(F.col(column).alias("low"), F.col(column).alias("high")))
    return told.agg(F.min("low").alias("low"), F.max("high").alias("high"))


def footer_schemas(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(period, file, column, type, position) of every file of the batch folders; no row is read."""
    periods = spark.createDataFrame([(_same_path(f), p) for p, f in folders.items()], "at string, period string")
    files = data_files(spark, *folders.values()).withColumn("at", F.regexp_replace("folder", "^file:/+", "/"))
    return (file_footers(files).join(files.join(periods, "at").select("file", "period"), "file")
            .select("period", "file", "column", "type", "position"))


def batch_shapes(footers: DataFrame) -> DataFrame:
    """(path, shape): the set of columns and types of every batch folder, or of its single files where they differ, from
    :func:`footer_schemas`."""
    files = (footers.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("column", "type"))).alias("shape"))
             .withColumn("folder", F.regexp_replace("file", "/[^/]*$", "")))
    alike = files.groupBy("folder").agg(F.min("shape").alias("shape"), F.count_distinct("shape").alias("n"))
    mixed = files.join(alike.filter("n > 1").select("folder"), "folder", "left_semi")
    return (alike.filter("n = 1").select(F.col("folder").alias("path"), "shape")
            .unionByName(mixed.select(F.col("file").alias("path"), "shape")))


def read_batches(spark: SparkSession, folders: dict[str, str], contract: Sequence[Field],
                 period_col: str = "period", base_path: str | None = None, keep: Sequence[str] = ()
                 ) -> DataFrame:
    """Read many batch folders whose files drift (renamed case, changed type, missing
    column): folders are grouped by footer schema (files, where those of a folder differ), each group is read in one
    scan and conformed to ``contract``, and the groups are unioned by name. (A single multi-file
    read of mixed schemas fails on type conflicts even with mergeSchema, and where it works
    a column missing from some files reads as null there, so a contract default would never
    apply.) ``period_col`` holds the value of each file's innermost ``key=value`` folder; with
    ``base_path`` all folder columns (e.g. year, month) are discovered and the ones named in
    ``keep`` are carried through."""
    shapes = batch_shapes(footer_schemas(spark, folders))
    # a path is a folder whose files are alike, or a file of a folder whose are not
    groups = shapes.groupBy("shape").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    out = None
    for paths in sorted(r.paths for r in groups.select("paths").collect()):
        reader = spark.read.option("basePath", base_path) if base_path else spark.read
        part = (reader.parquet(*paths)
                .withColumn(period_col, F.regexp_extract(F.col("_metadata.file_path"), r"=([^/]+)/[^/]*$", 1)))
        part = conform(part, contract, keep=[period_col, *keep])
        out = part if out is None else out.unionByName(part)
    return out


def file_manifest(spark: SparkSession, root: str, previous: DataFrame | None = None) -> DataFrame:
    """One row per data file below ``root``: file_path, file_bytes (from the listing), row_count (from the footer; no
    column is read), and ``status`` = 'skipped' when an earlier manifest already holds the same path with
    the same size, else 'downloaded'."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
              .select(F.col("path").alias("file_path"), F.col("length").alias("file_bytes")))
    rows = file_rows(spark, root).withColumnRenamed("file", "file_path")
    files = listed.join(rows, "file_path")
    if previous is None:
        return files.withColumn("status", F.lit("downloaded"))
    seen = previous.select(F.col("file_path").alias("__p"), F.col("file_bytes").alias("__b")).distinct()
    return (files.join(seen, (F.col("file_path") == F.col("__p")) & (F.col("file_bytes") == F.col("__b")), "left")
            .withColumn("status", F.when(F.col("__p").isNotNull(), "skipped").otherwise("downloaded"))
            .drop("__p", "__b"))


def folder_value(path: Column, name: str) -> Column:
    """Value of a ``name=value`` folder in a path."""
    return F.regexp_extract(path, f"/{name}=([^/]+)/", 1)

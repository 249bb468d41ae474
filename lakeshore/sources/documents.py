"""JSON documents: a multi-line JSON object per file (a series document) or a JSON array of
records (each element becomes a row). Always read with an explicit schema: inference
scans the data once more and drifts with the content."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOLIDAY_DDL = ("date string, name string, localName string, global boolean, "
               "counties array<string>, types array<string>")
WEATHER_DOC_DDL = ("timezone string, hourly struct<time: array<string>, temperature_2m: array<double>, "
                   "precipitation: array<double>, rain: array<double>, snowfall: array<double>, "
                   "wind_speed_10m: array<double>, weather_code: array<int>>")


def write_json_documents(docs: DataFrame, path: str, batch_cols: Sequence[str] = ("year", "month")) -> None:
    """One file per document, each holding one JSON object, in the document's batch folder. The
    rows of a batch are expected to be one document (what a download gives)."""
    docs.repartition(*batch_cols).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*batch_cols).json(path)


def write_json_arrays(records: DataFrame, path: str, batch: Column) -> None:
    """One file per batch, holding one JSON array of its records (a batch is a download: small)."""
    text = F.to_json(F.collect_list(F.struct(*records.columns)), {"ignoreNullFields": "false"})
    (records.groupBy(batch.alias("batch")).agg(text.alias("value")).repartition("batch")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").text(path))


def read_json(spark: SparkSession, path: str, ddl: str, multi_line: bool = False) -> DataFrame:
    """``multi_line=True`` for pretty-printed files holding one object or one array per file
    (a file is then not split; parallelism comes from the number of files)."""
    return spark.read.schema(ddl).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def write_json(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)

"""The columns of a stored table, kept with it: which there are, of which type, and since which batch.

A table whose batches were written over years has files with fewer columns than today's. Merging the schemas of all footers
tells the columns, but opens every file for it; the registry beside the table (``<root>.fields``, a few rows) is written
when batches are, and a read declares its schema: batches from before a column read null for it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeshore.sources.batches import exists

REGISTRY_DDL = "position int, name string, type string, since string"


def _registry(root: str) -> str:
    return f"{root.rstrip('/')}.fields"


def registered(spark: SparkSession, root: str) -> DataFrame:
    """(position, name, type, since) of the table's columns; ``since`` is null for those of the first build. Empty where
    the table has no registry. A column that two runs added at once counts from its first place."""
    if not exists(spark, _registry(root)):
        return spark.createDataFrame([], REGISTRY_DDL)
    rows = spark.read.schema(REGISTRY_DDL).json(_registry(root))
    return rows.groupBy("name").agg(F.min(F.struct("position", "type", "since")).alias("f")).select("f.position", "name", "f.type", "f.since")


def schema_of(spark: SparkSession, root: str) -> StructType | None:
    """The declared schema, in the order the columns came; None without a registry."""
    known = registered(spark, root).orderBy("position", "name").collect()
    if not known:
        return None
    return StructType.fromDDL(", ".join(f"`{r.name}` {r.type}" for r in known))


def record(spark: SparkSession, root: str, schema: StructType, since: str | None = None, replace: bool = False) -> list[str]:
    """Add the columns that the registry lacks, as present since a batch; their names. ``replace`` starts anew (a full
    refresh). A known column of another type raises, before anything is written."""
    known = [] if replace else registered(spark, root).collect()
    types = {r.name: r.type for r in known}
    wrong = {f.name: (types[f.name], f.dataType.simpleString()) for f in schema if types.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()}
    if wrong:
        raise ValueError(f"{root}: columns of another type than registered: {wrong}")
    at = max((r.position for r in known), default=-1) + 1
    new = [f for f in schema if f.name not in types]
    if new or replace:
        rows = spark.createDataFrame([(at + i, f.name, f.dataType.simpleString(), since) for i, f in enumerate(new)], REGISTRY_DDL)
        rows.coalesce(1).write.mode("overwrite" if replace else "append").json(_registry(root))
    return [f.name for f in new]


def read(spark: SparkSession, root: str) -> DataFrame:
    """The table with its declared schema, no footer merged; one without a registry is read as its footers say."""
    schema = schema_of(spark, root)
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(root)
    return spark.read.schema(schema).parquet(root).select(*schema.names)

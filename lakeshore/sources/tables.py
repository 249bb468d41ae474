"""Named source tables over a lake folder (one Parquet dataset per table)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# The source tables' contract (column, type), as their files hold them. Reading with it skips
# schema inference (a footer read on the driver per read) and fails loudly on drift.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy scan of ``<root>/<name>.parquet`` with the table's declared schema (inferred only
    for tables without one); selections and filters applied later are pushed into the scan
    by the optimizer (ReadSchema / PushedFilters)."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, root: str, names=TABLES) -> None:
    for name in names:
        table(spark, root, name).createOrReplaceTempView(name)

"""Columns registered with a table; uniqueness by counted hashes."""
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeshore.operators import expect
from lakeshore.operators.incremental import build_incremental
from lakeshore.operators.unique import repeated_keys
from lakeshore.session import scratch_path
from lakeshore.sources import fields


def test_registered_columns(spark):
    path = scratch_path(spark, "t-registered")
    old = spark.createDataFrame([(1, "2020-01"), (2, "2020-02")], "a int, m string")
    assert fields.schema_of(spark, path) is None
    build_incremental(spark, old, path, key="m")
    new = spark.createDataFrame([(3, "2020-02", 1.5)], "a int, m string, b double")
    build_incremental(spark, new, path, key="m", months="2020-02")
    assert rows(fields.read(spark, path), "a", "m", "b") == [(1, "2020-01", None), (3, "2020-02", 1.5)]
    assert rows(fields.registered(spark, path), "name", "type", "since") == [
        ("a", "int", None), ("b", "double", "2020-02"), ("m", "string", None)]
    retyped = new.withColumn("b", F.lit("x"))
    with pytest.raises(ValueError, match="another type"):
        build_incremental(spark, retyped, path, key="m", months="2020-02")
    assert rows(fields.read(spark, path), "a") == [(1,), (3,)]
    build_incremental(spark, retyped, path, key="m", full_refresh=True)                  # starts anew
    assert fields.read(spark, path).schema["b"].dataType.simpleString() == "string"
    assert rows(fields.registered(spark, path).where("name = 'b'"), "since") == [(None,)]


def test_a_table_without_registry_is_read_by_its_footers(spark):
    path = scratch_path(spark, "t-unregistered")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    assert rows(fields.read(spark, path)) == [(1,)]


def test_repeated_keys_equal_the_grouping(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"),       # a third on one key
                                  F.when(F.col("id") % 11 != 0, (F.col("id") % 2).cast("string")).alias("b"), F.lit(1).alias("n"))
    doubled = df.unionByName(df.where("a % 100 = 1"))
    for cols in (["a", "b"], "a", ["a", "b", "n"]):
        assert rows(repeated_keys(doubled, cols)) == rows(expect.unique(doubled, cols))
    assert rows(repeated_keys(doubled.limit(0), ["a"])) == []
    assert rows(repeated_keys(spark.range(100), "id")) == []

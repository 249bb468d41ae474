"""The driver contract: entry() smoke run, and every registered query against its DuckDB
statement on the smallest driver tables (the same comparison the driver runs at sf0.01)."""
import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


# the training-data operators are checked beside their own tests
CORE = sorted(k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k))


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(E.oracle_sql())


def test_approx_check_can_fail(spark):
    from pyspark.sql import functions as F

    from lakeshore.operators import profile

    df = spark.range(1, 20001).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("none"))
    out = {(r.column, r.stat): r.within for r in profile.approx_within(df, ["x", "none"], [0.25, 0.5]).collect()}
    assert out == {("x", s): True for s in ("min", "0.25", "0.5", "max")}
    rough = profile.approx_within(df, ["x"], [0.013, 0.5, 0.77], accuracy=10)     # promises little, keeps it
    assert all(r.within for r in rough.collect())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", CORE)
def test_query_matches_oracle(spark, duck, key):
    from tools.oracle_check import compare

    res = compare(spark, duck, key, E.queries()[key], E.oracle_sql().get(key), SF)
    assert res["status"] in ("OK", "rows-only"), res
    assert "type_mismatch" not in res, res          # every oracle column has the Spark column's type


def test_enrichment_never_shuffles_the_fact(spark):
    """All seven lookups are broadcast; the only hash shuffle is the trip stand-in's own
    lineitem/orders join (one exchange per side)."""
    df = E.queries()["enrich_star"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 7
    assert plan.count("Exchange hashpartitioning") <= 2

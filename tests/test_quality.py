"""Expectations (null semantics, freshness, suite summary) and profiling."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshore.operators import expect, profile


def test_expectation_null_rules(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, None), (None, "z", 150.0), (None, "b", -1.0)],
                               "k int, code string, x double")
    assert expect.not_null(df, "k").count() == 2
    assert [tuple(r) for r in expect.unique(df, "k").collect()] == [(1, 2)]         # nulls ignored
    assert expect.accepted_values(df, "code", ["a", "b"]).count() == 1               # 'z' only; null passes
    assert expect.in_range(df, "x", 0, 100).count() == 2                              # 150, -1; null passes
    assert expect.in_range(df, "x", 5.0, None).count() == 1                           # inclusive bound
    ref = spark.createDataFrame([(1,)], "id int")
    assert expect.relationships(df, "k", ref, "id").count() == 0                      # null keys ignored


def test_equal_rowcount_and_rows(spark):
    a, b = spark.range(3), spark.range(4)
    r = expect.equal_rowcount(a, b).first()
    assert (r.left_rows, r.right_rows, r.passed) == (3, 4, False)
    assert expect.rows(a, F.col("id") > 1).count() == 1


def test_freshness_status(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1),)], "loaded_at timestamp_ntz")
    now = "2025-03-01 00:00:00"                           # 59 days later
    assert expect.freshness(df, "loaded_at", now, 35, 60, "t").first().status == "warn"
    assert expect.freshness(df, "loaded_at", now, 35, 50, "t").first().status == "error"
    assert expect.freshness(df, "loaded_at", now, 400, None, "h").first().status == "pass"
    empty = spark.createDataFrame([], "loaded_at timestamp_ntz")
    assert expect.freshness(empty, "loaded_at", now, 35, 60, "t").first().status == "error"


def test_run_summary(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    out = {r.name: (r.failures, r.status) for r in expect.run([
        expect.Expectation("nn", expect.not_null(df, "k")),
        expect.Expectation("uq", expect.unique(df, "k"), "warn"),
        expect.Expectation("ok", expect.in_range(df, "k", 0, 5)),
    ]).collect()}
    assert out == {"nn": (1, "fail"), "uq": (1, "warn"), "ok": (0, "pass")}


def test_checks_nulls_breakdown(spark):
    df = spark.createDataFrame([(1, -2.0), (1, None), (2, 3.0)], "g int, x double")
    c = {r.check: (r.n_rows, r.share) for r in profile.checks(df, {"neg": F.col("x") < 0}).collect()}
    assert c == {"neg": (1, 0.333333)}
    n = {r.column: r.n_null for r in profile.nulls(df).collect()}
    assert n == {"g": 0, "x": 1}
    b = {r.g: (r.all_rows, r.neg) for r in profile.breakdown(df, "g", {"all_rows": F.lit(True), "neg": F.col("x") < 0}).collect()}
    assert b == {1: (2, 1), 2: (1, 0)}


def brute_quantile(values, p):
    v = np.sort(np.array([x for x in values if x is not None]))
    r = max(1, int(np.ceil(round(p * len(v), 9))))
    return float(v[r - 1])


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_brute_force_with_hot_value(spark, seed):
    rnd = random.Random(seed)
    n = 3000
    values = [7.0 if i % 3 == 0 else round(rnd.gauss(50, 20), 2) for i in range(n)]   # a third of rows share one value
    values += [None] * 40
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    long = df.select(F.lit("x").alias("column"), F.col("x").alias("v"))
    got = {r.stat: r.value for r in profile.exact_quantiles(long, probs, buckets=16).collect()}
    assert got == {f"{p:g}": brute_quantile(values, p) for p in probs}


def test_exact_summary_min_max(spark):
    df = spark.createDataFrame([(float(i), float(-i)) for i in range(1, 101)], "a double, b double")
    got = {(r.column, r.stat): r.value for r in profile.exact_summary(df, ["a", "b"], [0.5]).collect()}
    assert got[("a", "min")] == 1.0 and got[("a", "max")] == 100.0 and got[("a", "0.5")] == 50.0
    assert got[("b", "0.5")] == -51.0


def test_top_groups_tie_break(spark):
    df = spark.createDataFrame([(k,) for k in [3, 3, 1, 1, 2, 2, 5]], "k int")
    out = profile.top_groups(df, "k", 2, [F.count(F.lit(1)).alias("n")], "n").collect()
    assert [tuple(r) for r in out] == [(1, 2), (2, 2)]


def test_run_batches_row_checks_over_one_source(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 500.0), (3, None)], "k int, x double")
    out = {r.name: (r.failures, r.status) for r in expect.run([
        expect.row_check("k_not_null", df, expect.not_null_condition("k")),
        expect.row_check("x_range", df, expect.in_range_condition("x", 0, 100)),
        expect.row_check("x_pos", df, F.col("x") < 0, "warn"),
        expect.Expectation("k_unique", expect.unique(df, "k"), "warn"),
    ]).collect()}
    assert out == {"k_not_null": (1, "fail"), "x_range": (1, "fail"), "x_pos": (0, "pass"), "k_unique": (0, "pass")}


@pytest.mark.parametrize("max_window", [50, 10])
def test_exact_quantiles_iterative_narrowing(spark, max_window):
    """With a tiny per-task bound the ranges must be narrowed over several levels; the result
    stays exact (brute force), hot value included."""
    rnd = random.Random(7)
    values = [3.0 if i % 3 == 0 else float(rnd.randint(0, 5000)) for i in range(4000)]
    probs = [0.0, 0.01, 0.3, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    long = df.select(F.lit("x").alias("column"), F.col("x").alias("v"))
    got = {r.stat: r.value for r in profile.exact_quantiles(long, probs, buckets=8,
                                                            max_window_values=max_window).collect()}
    assert got == {f"{p:g}": brute_quantile(values, p) for p in probs}


def test_reference_flag_matches_relationships(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    ref = spark.createDataFrame([(1,), (1,)], "id int")                 # duplicates in the reference
    flagged = expect.with_reference_flag(df, "k", ref, "id", "orphan")
    assert flagged.count() == df.count()                               # no row multiplied
    assert flagged.filter("orphan").count() == expect.relationships(df, "k", ref, "id").count() == 2


def test_exact_summary_all_null_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None)], "a double, b double")
    got = {(r.column, r.stat): r.value for r in profile.exact_summary(df, ["a", "b"], [0.5]).collect()}
    assert got[("a", "0.5")] == 2.0 and got[("b", "min")] is None and got[("b", "0.5")] is None
    empty = spark.createDataFrame([], "a double")
    got = {(r.column, r.stat): r.value for r in profile.exact_summary(empty, ["a"], [0.5]).collect()}
    assert got == {("a", "min"): None, ("a", "max"): None, ("a", "0.5"): None}

"""One-pass profiling: conditional counts, null shares, per-group breakdowns, distribution
summaries; plus the small analytic queries (filtered count, distinct count, top groups)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.functions import round_half_up


def _long(wide: DataFrame, names: Sequence[str], total: str, label: str, count: str) -> DataFrame:
    long = wide.unpivot([total], list(names), label, count)
    return long.withColumn(
        "share", F.when(F.col(total) > 0, round_half_up(F.col(count) / F.col(total), 6)))


def checks(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """All conditions counted in a single scan (a null condition counts as 0):
    one row per check with ``n_rows`` and its share of all rows."""
    wide = df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(c).cast("long").alias(n) for n, c in conditions.items()])
    return _long(wide, list(conditions), "total_rows", "check", "n_rows")


def nulls(df: DataFrame, columns: Sequence[str] | None = None, only_with_nulls: bool = False) -> DataFrame:
    """Null count and share of every column, one scan."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    out = _long(wide, cols, "total_rows", "column", "n_null")
    return out.filter("n_null > 0") if only_with_nulls else out


def breakdown(df: DataFrame, by: str, groups: Mapping[str, Column]) -> DataFrame:
    """Per value of ``by``: the count of rows meeting each condition, in one pass."""
    return df.groupBy(by).agg(*[F.count_if(c).cast("long").alias(n) for n, c in groups.items()])


def approx_summary(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 10000
                   ) -> DataFrame:
    """(column, stat, value) with min, the approximate quantiles (bounded-memory sketch,
    rank error about n / accuracy), max; all columns stacked into one aggregate (one scan)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")
    ).select("s.column", "s.v")
    agg = long.groupBy("column").agg(F.min("v").alias("min"), F.max("v").alias("max"),
                                     F.percentile_approx("v", list(probs), accuracy).alias("q"))
    return agg.select("column", F.explode(F.array(
        F.struct(F.lit("min").alias("stat"), F.col("min").alias("value")),
        *[F.struct(F.lit(f"{p:g}").alias("stat"), F.col("q")[i].alias("value")) for i, p in enumerate(probs)],
        F.struct(F.lit("max").alias("stat"), F.col("max").alias("value")),
    )).alias("s")).select("column", "s.stat", "s.value")


def approx_within(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """(column, stat, within) for the statistics of :func:`approx_summary`: whether some rank of the
    value given lies within ``n / accuracy`` (and one rank) of the rank asked for; min and max exactly."""
    got = approx_summary(df, cols, probs, accuracy).withColumnRenamed("column", "of")
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols]))).where("v IS NOT NULL")
    counted = (long.join(F.broadcast(got), F.col("column") == F.col("of"))      # columns times statistics rows
               .groupBy("column", "stat", "value").agg(
                   F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("value")).alias("below"),
                   F.count_if(F.col("v") <= F.col("value")).alias("upto")))
    p = F.when(F.col("stat") == "min", 0.0).when(F.col("stat") == "max", 1.0).otherwise(F.col("stat").try_cast("double"))
    slack = F.when(F.col("stat").isin("min", "max"), 0).otherwise(F.col("n") / accuracy + 1)
    rank = F.greatest(F.lit(1), F.ceil(p * F.col("n")))
    return counted.select("column", "stat", ((F.col("below") + 1 <= rank + slack) & (F.col("upto") >= rank - slack)).alias("within"))


def with_bucket(df: DataFrame, value: str, cuts: str, n_cuts: int, out: str) -> DataFrame:
    """``out`` = number of ascending ``cuts`` below ``value`` (its range index), by binary
    search: log2(n_cuts) codegen'd ``element_at`` comparisons per row, one projection per
    step so the expression does not grow."""
    step = 1
    while step * 2 <= n_cuts:
        step *= 2
    df = df.withColumn(out, F.lit(0))
    while step >= 1:
        probe = F.col(out) + step
        df = df.withColumn(out, F.when((probe <= n_cuts) & (F.element_at(cuts, probe) < F.col(value)), probe)
                           .otherwise(F.col(out)))
        step //= 2
    return df


def _in_ranges(vals: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Rows of ``vals`` inside each range (lo, hi] of their key; ``ranges`` is a small literal
    frame (keys x probabilities rows), broadcast; an equi join on the key plus the range."""
    r = F.broadcast(ranges.withColumnRenamed(key, "__rk"))
    cond = ((F.col(key) == F.col("__rk"))
            & (F.col("lo").isNull() | (F.col("v") > F.col("lo")))
            & (F.col("hi").isNull() | (F.col("v") <= F.col("hi"))))
    return vals.join(r, cond).drop("__rk")


def exact_quantiles(long: DataFrame, probs: Sequence[float], key: str = "column", value: str = "v",
                    buckets: int = 256, max_window_values: int = 1_000_000,
                    stats: list | None = None) -> DataFrame:
    """Exact discrete quantiles per ``key`` of a long (key, value) frame: the smallest value
    whose cumulative share reaches p, i.e. the value of rank ceil(p * n) (p = 0 gives the
    minimum). No full shuffle, and no task ever orders more than about ``max_window_values``
    distinct values:

    1. one sketch pass per key: row count, approximate distinct count and ``buckets - 1``
       equal-rank cut points; each wanted rank starts with the key's whole range;
    2. while a wanted rank's range holds more than ``max_window_values`` distinct values,
       its rows are counted per sub-range of its cuts (tasks ship at most ``buckets`` rows per
       range) and the range narrows to the sub-range holding the rank, whose cut points come
       from one more sketch pass; only ranges, counts and cuts (keys x probs x buckets
       numbers) reach the driver;
    3. the rows inside each final range are grouped by value (a hot value is one row) and
       ordered in their own window partition.
    Returns (key, stat, value)."""
    spark = long.sparkSession
    vals = long.select(key, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    cut_probs = [i / buckets for i in range(1, buckets)]

    def sketch_aggs():
        return [F.approx_count_distinct("v").alias("nd"),
                F.percentile_approx("v", cut_probs, 10 * buckets).alias("cuts")]

    if stats is None:
        stats = vals.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("min"),
                                      F.max("v").alias("max"), *sketch_aggs()).collect()
    cands = []
    for row in stats:
        for p in probs:
            rank = max(1, math.ceil(Decimal(repr(p)) * row["n"]))
            cands.append({"key": row[key], "stat": f"{p:g}", "lo": None, "hi": None, "k": rank,
                          "nd": row["nd"], "cuts": list(row["cuts"])})
    range_ddl = f"`{key}` string, rid int, lo double, hi double"

    def shared(wanted):
        """Ranks in one range share it: (range number of each rank, the ranges)."""
        numbers: dict[tuple, int] = {}
        of = [numbers.setdefault((c["key"], c["lo"], c["hi"]), len(numbers)) for c in wanted]
        return of, {of[i]: c for i, c in enumerate(wanted)}

    # Every range is narrowed at least once: sub-ranges of different ranks are disjoint, so a
    # row meets about one range in each pass.
    pending = list(cands)
    while pending:
        before_level = [(c["lo"], c["hi"], c["nd"]) for c in pending]
        of, ranges = shared(pending)
        frame = spark.createDataFrame([(c["key"], r, c["lo"], c["hi"], c["cuts"]) for r, c in ranges.items()],
                                      range_ddl + ", cuts array<double>")
        inside = with_bucket(_in_ranges(vals, frame, key), "v", "cuts", buckets - 1, "b")
        counts = {(r["rid"], r["b"]): r["bc"] for r in inside.groupBy("rid", "b").agg(F.count(F.lit(1)).alias("bc")).collect()}
        for rid, c in zip(of, pending, strict=True):
            before = 0
            for b in range(buckets):
                bc = counts.get((rid, b), 0)
                if before + bc >= c["k"]:
                    lo = c["cuts"][b - 1] if b > 0 else c["lo"]
                    hi = c["cuts"][b] if b < buckets - 1 else c["hi"]
                    c.update(lo=lo, hi=hi, k=c["k"] - before, nd=bc)   # rows bound the distinct values
                    break
                before += bc
        wide = [c for c in pending if c["nd"] > max_window_values]
        if wide:   # cut points (and a distinct estimate) for ranges that are still too wide
            of, ranges = shared(wide)
            narrowed = spark.createDataFrame([(c["key"], r, c["lo"], c["hi"]) for r, c in ranges.items()], range_ddl)
            found = {r["rid"]: r for r in _in_ranges(vals, narrowed, key).groupBy("rid").agg(*sketch_aggs()).collect()}
            for rid, c in zip(of, wide, strict=True):
                c.update(nd=found[rid]["nd"], cuts=list(found[rid]["cuts"]))
        if len(wide) == len(before_level) and [(c["lo"], c["hi"], c["nd"]) for c in wide] == before_level:
            raise RuntimeError(f"ranges of {key} that no longer narrow hold more than {max_window_values} values")
        pending = [c for c in wide if c["nd"] > max_window_values]
    of, ranges = shared(cands)
    final = spark.createDataFrame([(c["key"], r, c["lo"], c["hi"]) for r, c in ranges.items()], range_ddl)
    wanted = spark.createDataFrame([(r, c["stat"], c["k"]) for r, c in zip(of, cands, strict=True)], "__rid int, stat string, k long")
    in_final = _in_ranges(vals, final, key).groupBy(key, "rid", "v").agg(F.count(F.lit(1)).alias("c"))
    ordered = in_final.withColumn("cum", F.sum("c").over(
        Window.partitionBy("rid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ordered.join(F.broadcast(wanted), (F.col("rid") == F.col("__rid")) & (F.col("cum") >= F.col("k")))   # keys x probs rows
    return ranked.groupBy(key, "stat").agg(F.min("v").alias("value"))


def exact_summary(df: DataFrame, cols: Sequence[str], probs: Sequence[float], buckets: int = 256,
                  max_window_values: int = 1_000_000) -> DataFrame:
    """(column, stat, value): min, exact discrete quantiles, max of every column. The columns
    are stacked into one long frame, so all of them share the same passes; min and max come
    from the first sketch pass. An all-null column reports null statistics."""
    spark = df.sparkSession
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")
    ).select("s.column", "s.v")
    vals = long.filter("v IS NOT NULL")
    stats = vals.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.approx_count_distinct("v").alias("nd"),
        F.percentile_approx("v", [i / buckets for i in range(1, buckets)], 10 * buckets).alias("cuts")).collect()
    seen = {r["column"]: r for r in stats}
    ends = [(c, "min", seen[c]["min"] if c in seen else None) for c in cols]
    ends += [(c, "max", seen[c]["max"] if c in seen else None) for c in cols]
    ends += [(c, f"{p:g}", None) for c in cols if c not in seen for p in probs]
    out = spark.createDataFrame(ends, "column string, stat string, value double")
    if stats:
        out = out.unionByName(exact_quantiles(long, probs, "column", "v", buckets, max_window_values, stats=stats))
    return out


def filtered_count(df: DataFrame, condition: Column | str, name: str = "n_rows") -> DataFrame:
    return df.filter(condition).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, name: str = "n_distinct") -> DataFrame:
    """Exact distinct count (a full shuffle of the distinct values; nothing to pre-shrink)."""
    return df.agg(F.count_distinct(col).alias(name))


def top_groups(df: DataFrame, key: str, k: int, aggs: Sequence[Column], order_col: str) -> DataFrame:
    """The ``k`` largest groups by ``order_col`` (ties broken by key): partial aggregation
    before the shuffle, then TakeOrderedAndProject keeps k rows per task."""
    return df.groupBy(key).agg(*aggs).orderBy(F.desc(order_col), F.asc(key)).limit(k)

"""Data-quality expectations. Each returns the **failing rows** as a DataFrame (empty =
pass); :func:`run` evaluates many of them as one union of tiny aggregates.

Null rules follow the usual warehouse test semantics: ``unique``, ``relationships``,
``accepted_values`` and ``in_range`` ignore nulls; ``not_null`` is the only null check.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.operators.enrich import duplicate_keys


def not_null_condition(col: str) -> Column:
    return F.col(col).isNull()


def accepted_values_condition(col: str, values: Sequence) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def in_range_condition(col: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        bad = bad | ((c > max_value) if inclusive else (c >= max_value))
    return c.isNotNull() & bad


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(not_null_condition(col))


def unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Key values held by more than one row, with the count (nulls ignored)."""
    return duplicate_keys(df, [cols] if isinstance(cols, str) else list(cols))


def relationships(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Rows whose non-null ``col`` has no match in ``ref.ref_col`` (orphans): an anti join
    against the distinct reference keys."""
    keys = ref.select(F.col(ref_col).alias("__ref")).distinct()
    return df.filter(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("__ref"), "left_anti")


def with_reference_flag(df: DataFrame, col: str, ref: DataFrame, ref_col: str, flag: str) -> DataFrame:
    """``df`` plus a boolean ``flag``: its non-null ``col`` has no match in ``ref.ref_col``.
    The relationship test becomes a row-level condition, so it can be counted in the same
    scan as the other row checks (the distinct reference keys are joined once)."""
    keys = ref.select(F.col(ref_col).alias(f"__{flag}")).distinct()
    joined = df.join(keys, F.col(col) == F.col(f"__{flag}"), "left")
    return joined.withColumn(flag, F.col(col).isNotNull() & F.col(f"__{flag}").isNull()).drop(f"__{flag}")


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(accepted_values_condition(col, values))


def in_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside [min, max] (open ends when None); nulls pass."""
    return df.filter(in_range_condition(col, min_value, max_value, inclusive))


def rows(df: DataFrame, failing: Column) -> DataFrame:
    """A singular test: the rows for which ``failing`` is true (null = pass)."""
    return df.filter(failing)


def equal_rowcount(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both counts and ``passed``; two global counts, a 1 x 1 cross join."""
    a = left.agg(F.count(F.lit(1)).alias("left_rows"))
    b = right.agg(F.count(F.lit(1)).alias("right_rows"))
    return a.crossJoin(b).withColumn("passed", F.col("left_rows") == F.col("right_rows"))


def freshness(df: DataFrame, loaded_at: str, now, warn_after_days: float | None,
              error_after_days: float | None, source: str) -> DataFrame:
    """Age of the newest ``loaded_at`` at instant ``now`` (a parameter: results never
    depend on the wall clock) and a status pass / warn / error."""
    now_c = F.lit(now).cast("timestamp_ntz") if not isinstance(now, Column) else now
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_c) / 86400.0
    status = F.lit("pass")
    if warn_after_days is not None:
        status = F.when(F.col("age_days") > warn_after_days, "warn").otherwise(status)
    if error_after_days is not None:
        status = F.when(F.col("age_days") > error_after_days, "error").otherwise(status)
    return (newest.withColumn("age_days", F.round(age, 3))
            .withColumn("status", F.when(F.col("max_loaded_at").isNull(), "error").otherwise(status))
            .select(F.lit(source).alias("source"), "max_loaded_at", "age_days", "status"))


@dataclass
class Expectation:
    name: str
    failing: DataFrame | None = None
    severity: str = "error"
    source: DataFrame | None = None       # row-level form: rows of `source` where `condition` holds
    condition: Column | None = None


def row_check(name: str, source: DataFrame, condition: Column, severity: str = "error") -> Expectation:
    """A row-level expectation; :func:`run` evaluates all of those over one source together."""
    return Expectation(name, None, severity, source, condition)


def run(expectations: Sequence[Expectation]) -> DataFrame:
    """(name, severity, failures, status) for every expectation, as one job. Row-level
    expectations over the same source are counted together in a single scan of it (one
    conditional count each); the others (uniqueness, relationships, ...) are a global count
    of their failing rows each."""
    groups: dict[int, tuple[DataFrame, list[Expectation]]] = {}
    parts = []
    for e in expectations:
        if e.condition is not None:
            groups.setdefault(id(e.source), (e.source, []))[1].append(e)
        else:
            parts.append(e.failing.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(e.name).alias("name"), F.lit(e.severity).alias("severity"), "failures"))
    for source, checks in groups.values():
        wide = source.agg(*[F.count_if(e.condition).alias(f"__c{i}") for i, e in enumerate(checks)])
        parts.append(wide.select(F.explode(F.array(*[
            F.struct(F.lit(e.name).alias("name"), F.lit(e.severity).alias("severity"),
                     F.col(f"__c{i}").cast("long").alias("failures"))
            for i, e in enumerate(checks)])).alias("r")).select("r.name", "r.severity", "r.failures"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn(
        "status",
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))

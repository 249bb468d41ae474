"""Rule-based quarantine: the first broken rule (in priority order) becomes the reject reason.

A rule whose condition evaluates to null counts as *not broken* (a null fare is kept).
The reason column is one flat ``CASE WHEN`` chain, a projection; the split into accepted
and quarantined rows is one partitioned write or two filters over the same plan.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def first_broken_rule(rules: Sequence[Rule]) -> Column:
    """Name of the first rule whose condition is true, else null."""
    if not rules:
        return F.lit(None).cast("string")
    (name, cond), *rest = rules
    expr = F.when(cond, F.lit(name))
    for name, cond in rest:
        expr = expr.when(cond, F.lit(name))
    return expr


def with_reason(df: DataFrame, rules: Sequence[Rule], reason_col: str = "reject_reason") -> DataFrame:
    return df.withColumn(reason_col, first_broken_rule(rules))


def filter_computed(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)`` for a condition on computed columns, which stay computed once. Catalyst
    would push the filter below the projections (into a join's condition, even), repeating every
    expression behind the columns for each use: code too long to be compiled. It leaves a filter alone that also reads
    a row number of the projection below. Filters set later do not pass it either: prune
    batches on the rows before they are judged."""
    row = "__row"
    while row in df.columns:
        row += "_"
    return df.withColumn(row, F.monotonically_increasing_id()).filter(condition & (F.col(row) >= 0)).drop(row)


def accepted(df: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    return filter_computed(df, F.col(reason_col).isNull()).drop(reason_col)


def quarantined(df: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    return filter_computed(df, F.col(reason_col).isNotNull())


def split(df: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted without the reason column, quarantined with it)."""
    return accepted(df, reason_col), quarantined(df, reason_col)


def reason_histogram(df: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """Rows per reject reason, most frequent first (ties by name). Map-side partial
    aggregation shrinks each partition to a handful of rows before the shuffle."""
    return (
        quarantined(df, reason_col)
        .groupBy(reason_col).agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), reason_col)
    )


def split_counts(df: DataFrame, reason_col: str = "reject_reason", by: Sequence[str] = ()) -> DataFrame:
    """Input, accepted and quarantined row counts (per batch when ``by`` is given) and whether
    they reconcile (input = accepted + quarantined); one pass over the rows."""
    counts = df.groupBy(*by).agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col(reason_col).isNull()).alias("accepted_rows"),
        F.count_if(F.col(reason_col).isNotNull()).alias("quarantined_rows"),
    )
    return counts.withColumn(
        "reconciled", F.col("input_rows") == F.col("accepted_rows") + F.col("quarantined_rows")
    )


class ReconcileError(RuntimeError):
    pass


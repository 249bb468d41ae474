"""Fact-side aggregation and calendar-anchored marts."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions import round_half_up


def rounded_avg(col: str, scale: int = 2) -> Column:
    return round_half_up(F.avg(F.col(col).cast("double")), scale)


def hourly_demand(facts: DataFrame, hour_col: str = "pickup_hour") -> DataFrame:
    """Per hour: trips, passengers, rounded means of duration, distance, total and tip
    percentage (nulls ignored), and the count of airport trips. Map-side partial
    aggregation reduces every task to one row per hour before the shuffle."""
    return facts.groupBy(hour_col).agg(
        F.count("*").alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        rounded_avg("duration_min").alias("avg_duration_min"),
        rounded_avg("trip_distance_miles").alias("avg_distance_miles"),
        rounded_avg("total_amount").alias("avg_total_amount"),
        rounded_avg("tip_pct").alias("avg_tip_pct"),
        F.count_if(F.col("is_airport_trip")).alias("airport_trips"),
    )


def anchored(calendar: DataFrame, by_key: DataFrame, on: tuple[str, str],
             zero_fill: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """``calendar`` left join ``by_key``: every calendar row survives; measures listed in
    ``zero_fill`` become 0 where the key has no facts, the others stay null."""
    cal_col, key_col = on
    right = by_key.withColumnRenamed(key_col, "__key")
    joined = calendar.join(right, calendar[cal_col] == right["__key"], "left").drop("__key")
    for c in zero_fill:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return joined if keep is None else joined.select(*keep)


def totals_mismatch(left: DataFrame, right: DataFrame, left_total: Column, right_total: Column,
                    names: Mapping[str, str] = None) -> DataFrame:
    """One row (the two totals) when they differ, else no rows: a reconciliation test.
    Both sides are single-row global aggregates, so the cross join is 1 x 1."""
    names = names or {"left": "left_total", "right": "right_total"}
    a = left.agg(left_total.alias(names["left"]))
    b = right.agg(right_total.alias(names["right"]))
    return a.crossJoin(b).filter(~F.col(names["left"]).eqNullSafe(F.col(names["right"])))

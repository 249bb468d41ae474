"""Typed column contracts: conform drifting raw frames, and report schema drift.

A contract is an ordered list of :class:`Field` (target name, source name, type, optional
default). Source names match case-insensitively; a missing column with a default becomes
that literal, a missing one without a default is an error, unknown extra columns are
reported and dropped. All of it is a single projection: no shuffle, no job.
"""
from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MISSING = object()


@dataclass(frozen=True)
class Field:
    target: str
    source: str
    dtype: T.DataType | str
    default: Any = _MISSING

    @property
    def has_default(self) -> bool:
        return self.default is not _MISSING


class ContractError(ValueError):
    pass


def match_sources(columns: Sequence[str], contract: Sequence[Field]) -> tuple[dict[str, str | None], list[str]]:
    """Where each target comes from (a column of the input whatever its case, or None for the field's
    default), and the input columns that no field uses. All fields without source and default are named at once."""
    spelled = {c.casefold(): c for c in columns}
    sources = {f.target: spelled.get(f.source.casefold()) for f in contract}
    lost = [f.source for f in contract if sources[f.target] is None and not f.has_default]
    if lost:
        raise ContractError(f"columns missing from the input, without a default: {', '.join(lost)}")
    return sources, sorted(set(columns) - set(sources.values()))


def unexpected_columns(columns: Sequence[str], contract: Sequence[Field]) -> list[str]:
    names = {f.source.casefold() for f in contract}
    return sorted(c for c in columns if c.casefold() not in names)


def conform(df: DataFrame, contract: Sequence[Field], on_cast: str = "strict",
            keep: Sequence[str] = ()) -> DataFrame:
    """Rename, cast and order ``df`` to ``contract``; ``keep`` passes batch columns through. Columns that
    are neither used nor kept are dropped with a warning.

    ``on_cast='strict'`` uses ANSI ``cast`` (a bad value fails the job);
    ``'null'`` uses ``try_cast`` so a bad value becomes null (pair it with a rule)."""
    sources, unused = match_sources(df.columns, contract)
    if extra := [c for c in unused if c not in keep]:
        warnings.warn(f"dropped columns that the contract does not know: {', '.join(extra)}", stacklevel=2)
    cast = Column.cast if on_cast == "strict" else Column.try_cast
    values = {t: F.col(f"`{c}`") for t, c in sources.items() if c is not None}
    return df.select(
        *[cast(values.get(f.target, F.lit(f.default if f.has_default else None)), f.dtype).alias(f.target) for f in contract],
        *[F.col(f"`{k}`") for k in keep])


def schema_drift(columns_by_period: DataFrame) -> DataFrame:
    """Drift report from (period, column, type) rows, one per file and column; a period whose files
    differ shows its types joined by '|'.

    One row per (column, period) with the column's type there or 'MISSING', ``differs`` when
    the column's type or presence varies between periods, and ``spellings``: the
    comma-joined case variants of the name when there is more than one, else null.
    A column's types are one map (period -> type) and the periods one array: the grid is their explode,
    without a join per cell. The input is footer metadata, a few rows per file."""
    of_period = columns_by_period.groupBy("column", "period").agg(
        F.array_join(F.sort_array(F.collect_set("type")), "|").alias("type"))
    by_name = of_period.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("period", "type"))).alias("types"))
    variants = by_name.groupBy(F.lower("column").alias("name")).agg(F.sort_array(F.collect_list("column")).alias("spelled"))
    periods = columns_by_period.agg(F.sort_array(F.collect_set("period")).alias("periods"))
    grid = (by_name.join(variants, F.lower("column") == F.col("name")).join(F.broadcast(periods))    # one row
            .withColumn("filled", F.transform("periods", lambda p: F.coalesce(F.col("types")[p], F.lit("MISSING")))))
    return grid.select(
        "column", F.explode(F.arrays_zip("periods", F.col("filled").alias("type"))).alias("cell"),
        (F.size(F.array_distinct("filled")) > 1).alias("differs"),
        F.when(F.size("spelled") > 1, F.array_join("spelled", ",")).alias("spellings"),
    ).select("column", F.col("cell.periods").alias("period"), F.col("cell.type").alias("type"), "differs", "spellings")

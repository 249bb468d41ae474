"""Row-preserving star enrichment: a chain of left joins on keys that are unique on the
right-hand side, so the output has exactly the input's rows.

Broadcast policy (what decides the physical join):
- ``broadcast=True``  the lookup is a fixed code list: it is shipped to every task and the fact side
  is never shuffled for it;
- otherwise           the planner decides from statistics (the file size of a stored table) and its
  broadcast threshold, and AQE re-plans at run time (sort-merge, skew handling).
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Lookup:
    df: DataFrame
    on: Mapping[str, str]                 # left column -> right key column
    columns: Mapping[str, str]            # right column -> output name
    broadcast: bool = False
    name: str = field(default="lookup")
    verify_unique: bool = False           # check the key is unique before joining (data lookups)


class UniquenessError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (null keys ignored), with their count."""
    return (df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1"))


def assert_all_unique(lookups: Sequence["Lookup"]) -> None:
    """Verify several lookups' keys in one job: a union of (lookup, duplicated key count),
    at most a few small rows per lookup reach the driver."""
    if not lookups:
        return
    parts = [duplicate_keys(lk.df, list(lk.on.values())).limit(3).select(
        F.lit(i).alias("i"), F.to_json(F.struct(*lk.on.values())).alias("key"), "n_rows")
        for i, lk in enumerate(lookups)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    bad = union.collect()
    if bad:
        names = {lookups[r.i].name for r in bad}
        raise UniquenessError(f"lookup key not unique in {sorted(names)}, e.g. {[(r.key, r.n_rows) for r in bad]}")


def _prepared(lk: Lookup, i: int) -> tuple[DataFrame, list[str]]:
    keys = [f"__lk{i}_{j}" for j in range(len(lk.on))]
    right = lk.df.select(
        *[F.col(r).alias(k) for r, k in zip(lk.on.values(), keys)],
        *[F.col(c).alias(out) for c, out in lk.columns.items()],
    )
    return (F.broadcast(right) if lk.broadcast else right), keys


def enrich(df: DataFrame, lookups: Sequence[Lookup], check_unique: bool = False) -> DataFrame:
    """Left-join every lookup in order. Keys of lookups marked ``verify_unique`` (all of them
    with ``check_unique``) are verified first, in one job: a duplicated key would multiply
    fact rows, so the join refuses and names example keys instead of deduplicating."""
    assert_all_unique([lk for lk in lookups if check_unique or lk.verify_unique])
    out = df
    for i, lk in enumerate(lookups):
        right, keys = _prepared(lk, i)
        cond = reduce(lambda a, b: a & b, [out[left] == right[k] for left, k in zip(lk.on, keys)])
        out = out.join(right, cond, "left").drop(*keys)
    return out

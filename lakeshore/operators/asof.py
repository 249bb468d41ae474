"""As-of lookup by sorting: versions and facts in one ordered run per key, the last version carried forward.

The equi join of :func:`lakeshore.operators.history.as_of` compares every fact with every version of its key, so
a key with 10,000 versions and a third of the facts multiplies them. Here each row is sorted once, whatever
the number of versions. A hot key's run is cut by time: its facts' equal-rank instants are the cut points, and a version
goes to every slice that it reaches into, which for versions that do not overlap is at most one more row per slice.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.operators.history import FAR_FUTURE
from lakeshore.operators.profile import with_bucket
from lakeshore.session import materialize

INSTANT = "timestamp_ntz"


def _hot_cuts(live: DataFrame, keys: Sequence[str], hot_rows: int, slices: int) -> DataFrame | None:
    """(keys, cuts): the equal-rank instants of every key with more than ``hot_rows`` facts, stored (so that the planner
    knows its size); None where no key is hot. At most facts / ``hot_rows`` rows."""
    spark = live.sparkSession
    hot = materialize(spark, live.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows).drop("n"), "as-of-hot")
    if hot.isEmpty():
        return None
    ranks = [i / slices for i in range(1, slices)]
    cuts = live.join(hot, list(keys), "left_semi").groupBy(*keys).agg(F.percentile_approx("__t", ranks, 10 * slices).alias("__cuts"))
    return materialize(spark, cuts, "as-of-cuts")


def _reach(df: DataFrame, start: str, end: str, cuts: DataFrame | None, keys: Sequence[str], slices: int) -> DataFrame:
    """``__lo``, ``__hi``: the first slice that rows of instant ``start`` may be in, and the last of ``end``. An instant that
    is several cut points at once belongs to all slices between them."""
    if cuts is None:
        return df.withColumns({"__lo": F.lit(0), "__hi": F.lit(0)})
    df = df.join(cuts, list(keys), "left").withColumn("__after", F.col(end) + F.expr("INTERVAL '0.000001' SECOND"))
    df = with_bucket(df, start, "__cuts", slices - 1, "__lo")
    return with_bucket(df, "__after", "__cuts", slices - 1, "__hi").drop("__cuts", "__after")


def as_of_sorted(facts: DataFrame, ts: str, history: DataFrame, keys: dict[str, str], columns: Sequence[str],
                 hot_rows: int = 5_000_000, slices: int = 256) -> DataFrame:
    """Each fact row with the history ``columns`` of the version valid at its ``ts`` (valid_from <= ts < valid_to, open
    versions unbounded); null when none was valid. ``keys`` maps fact columns to history columns.

    Versions of a key must not overlap (an empty one, closed the instant it opened, is never valid). Rows with
    a null key or instant keep nulls and are spread over the slices, not gathered. Repeated facts all stay. A history column
    named like a fact column is an error. The facts are read three times where a key is hot (keys and instants only, but for
    the last), twice otherwise: hand in a stored table."""
    clash = sorted(set(facts.columns) & set(columns))
    if clash:
        raise ValueError(f"history columns named like fact columns: {clash}")
    names = [f"__k{i}" for i in range(len(keys))]
    quoted = lambda c: F.col(f"`{c}`")
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    hashed = [quoted(f.name) for f in facts.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]

    f = facts.select(*[quoted(k).alias(n) for k, n in zip(keys, names, strict=True)], quoted(ts).cast(INSTANT).alias("__t"),
                     F.struct(*[quoted(c) for c in facts.columns]).alias("__row"), F.xxhash64(*hashed).alias("__hash"))
    v = history.select(*[quoted(h).alias(n) for h, n in zip(keys.values(), names, strict=True)],
                       F.col("valid_from").cast(INSTANT).alias("__t"),
                       F.coalesce(F.col("valid_to").cast(INSTANT), F.lit(FAR_FUTURE).cast(INSTANT)).alias("__to"),
                       F.struct(*[quoted(c) for c in columns]).alias("__values")).filter(known & (F.col("__t") < F.col("__to")))
    live = known & F.col("__t").isNotNull()
    cuts = _hot_cuts(f.filter(live).select(*names, "__t"), names, hot_rows, slices)

    spread = F.when(live, F.col("__lo") + F.pmod(F.col("__hash"), F.col("__hi") - F.col("__lo") + 1)).otherwise(F.pmod("__hash", F.lit(slices)))
    f = (_reach(f, "__t", "__t", cuts, names, slices)
         .select(*names, "__t", spread.cast("int").alias("__slice"), F.lit(1).alias("__kind"), "__row"))
    v = (_reach(v, "__t", "__to", cuts, names, slices)
         .select(*names, "__t", F.explode(F.sequence("__lo", "__hi")).alias("__slice"), F.lit(0).alias("__kind"),
                 F.struct("__to", "__values").alias("__version")))
    run = (Window.partitionBy(*names, "__slice").orderBy(F.asc_nulls_first("__t"), "__kind")     # a version before facts of its instant
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = f.unionByName(v, allowMissingColumns=True).withColumn("__last", F.last("__version", ignorenulls=True).over(run))
    valid = F.col("__t") < F.col("__last.__to")
    return both.filter("__kind = 1").select("__row.*", *[F.when(valid, F.col(f"__last.__values.`{c}`")).alias(c) for c in columns])

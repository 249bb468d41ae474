"""Profiles stored per batch and merged for any set of batches, so that one changed batch costs reading one batch.

Two structures, both made and merged by built-in aggregates:

- **quantile sketches** (KLL) of numeric columns: a few kB per batch and column, with a rank error that merging does
  not widen;
- **bitmaps** of instants or whole numbers: exact, so that the distinct values of many batches can be counted without
  reading them again. 32,768 consecutive seconds (or numbers) share a bitmap of 4 kB: for values that lie densely.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType, TimestampType

from lakeshore.session import require_utc
from lakeshore.sources.batches import same_batches, write_batches

#: Accuracy of the sketches: an estimate's rank is off by less than RANK_ERROR of the rows (99 % of the time, by the
#: sketch's own promise 0.35 % at this size).
SKETCH_K = 800
RANK_ERROR = 0.01


def sketch_batches(df: DataFrame, batch_cols: Sequence[str], columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One row per (batch, column): rows, values (not null, not NaN), least, greatest and the sketch."""
    stacked = df.select(*batch_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("s"))
    value = F.when(~F.isnan("s.v"), F.col("s.v"))
    return (stacked.select(*batch_cols, F.col("s.column").alias("column"), value.alias("v")).groupBy(*batch_cols, "column")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n_values"), F.min("v").alias("least"),
                 F.max("v").alias("greatest"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch")))


def merged_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n_rows, n_values, least, greatest, quantiles): the stored sketches of the given batches merged;
    ``quantiles`` has one estimate per probability (null where no batch has a value)."""
    merged = sketches.groupBy(*by, "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_double(F.when(F.col("n_values") > 0, F.col("sketch"))).alias("sketch"))
    asked = F.array(*[F.lit(float(p)) for p in probs])
    return merged.withColumn("quantiles", F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("sketch", asked))).drop("sketch")


def rank_report(df: DataFrame, merged: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str],
                error: float = RANK_ERROR) -> DataFrame:
    """Merged rows without the quantiles, with ``within_promise``: whether the share of values of ``df`` below (up to) every
    estimate leaves its probability within ``error``; null where there is no value. One pass, counted per task."""
    stacked = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("s"))
    values = stacked.select(*by, "s.column", "s.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    keys = [*by, "column"]
    counted = values.join(merged.select(*keys, "quantiles"), keys).groupBy(*keys).agg(
        *[F.count_if(F.col("v") < F.col("quantiles")[i]).alias(f"__b{i}") for i in range(len(probs))],
        *[F.count_if(F.col("v") <= F.col("quantiles")[i]).alias(f"__u{i}") for i in range(len(probs))])
    within = F.lit(True)
    for i, p in enumerate(probs):
        within = within & (F.col(f"__b{i}") <= (p + error) * F.col("n_values")) & (F.col(f"__u{i}") >= (p - error) * F.col("n_values"))
    return (merged.drop("quantiles").join(counted, keys, "left")
            .select(*merged.drop("quantiles").columns, F.when(F.col("n_values") > 0, within).alias("within_promise")))


def bitmap_batches(df: DataFrame, batch_cols: Sequence[str], column: str) -> DataFrame:
    """(batch, bucket, rest, bits): the distinct values of ``column``, an instant or a whole number, as bitmaps. Instants
    are told by their second and the microseconds left over, which have a bitmap of their own; nulls have none."""
    kind = df.schema[column].dataType
    if isinstance(kind, (TimestampNTZType, TimestampType)):
        require_utc(df.sparkSession)
        micros = F.unix_micros(F.col(column).cast("timestamp"))
        rest = F.pmod(micros, F.lit(1_000_000).cast("long"))
        number = ((micros - rest) / 1_000_000).cast("long")      # whole, and below 2^53: no digit is lost
    elif isinstance(kind, IntegralType):
        rest, number = F.lit(0).cast("long"), F.col(column).cast("long")
    else:
        raise TypeError(f"{column} is {kind.simpleString()}: bitmaps hold instants and whole numbers")
    values = df.filter(F.col(column).isNotNull()).select(*batch_cols, number.alias("number"), rest.alias("rest"))
    return (values.groupBy(*batch_cols, F.bitmap_bucket_number("number").alias("bucket"), "rest")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def distinct_from_bitmaps(bitmaps: DataFrame, by: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """Exact number of distinct values per ``by`` (over all batches, if empty: one row, 0 where there is none)."""
    merged = bitmaps.groupBy(*by, "bucket", "rest").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(name))


def refresh(spark: SparkSession, df: DataFrame, store: str, batch_cols: Sequence[str], profile, changed: DataFrame | None = None) -> DataFrame:
    """Bring the stored profile at ``store`` up to date and return it. ``profile`` maps rows to profile rows per batch
    (:func:`sketch_batches`, :func:`bitmap_batches`). With ``changed`` (one row per changed batch, metadata-sized) only
    those batches are read and replaced; a changed batch without rows keeps no row. Without, every batch of ``df`` is."""
    from lakeshore.sources.batches import exists, purge_partitions

    parts = list(batch_cols)
    schema = profile(df).schema
    if changed is None:
        write_batches(profile(df), store, parts, files_per_batch=1)
        return spark.read.schema(schema).parquet(store)
    named = [tuple(r) for r in changed.select(*parts).distinct().collect()]
    wanted = F.lit(False)
    for values in named:                       # literals, so that the other batches' folders are not opened
        same = F.lit(True)
        for c, x in zip(parts, values, strict=True):
            same = same & F.col(c).eqNullSafe(F.lit(x))
        wanted = wanted | same
    held = lambda: spark.read.schema(schema).parquet(store)
    before = set()
    if named and exists(spark, store):
        before = {tuple(r) for r in same_batches(held(), changed, parts).select(*parts).distinct().collect()}
    write_batches(profile(df.filter(wanted)), store, parts, files_per_batch=1)
    if before:
        still = {tuple(r) for r in df.filter(wanted).select(*parts).distinct().collect()}
        purge_partitions(spark, store, [dict(zip(parts, b, strict=True)) for b in before if b not in still])
    return held()

"""Uniqueness by two passes: hashes of keys are counted first, and only keys whose hash was met twice are shuffled.

Grouping by the key moves every key, however wide, to find that hardly any repeats. The first pass moves a 64-bit
hash per row instead (counted per task before); the hashes met more than once are stored, which tells their size, and the
second pass groups, exactly, the keys of those only. Equal keys have equal hashes, so no repeated key is lost; two keys that
share a hash cost two rows more in the second pass, never a wrong answer. The rows are read twice, their key columns only.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.operators.enrich import duplicate_keys
from lakeshore.session import materialize

HASH = "__key_hash"


def repeated_keys(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Key values held by more than one row, with the count, as :func:`lakeshore.operators.expect.unique` gives them
    (rows with a null in the key are left out). A key that holds a third of all rows is one row per task after the
    partial counts of both passes."""
    names = [cols] if isinstance(cols, str) else list(cols)
    keys = df.select(*names).dropna(subset=names).withColumn(HASH, F.xxhash64(*names))
    met_twice = keys.groupBy(HASH).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(HASH)
    suspects = materialize(df.sparkSession, met_twice, "repeated-hashes")
    return duplicate_keys(keys.join(suspects, HASH, "left_semi").drop(HASH), names)

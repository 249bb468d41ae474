"""Deterministic surrogate keys."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshore.functions.derive import ColumnOrName, _col

# Fixed value: text standing in for a null part of a key, so (null, 'a') and ('', 'a') differ.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 of the parts cast to text, nulls replaced by a placeholder, joined by '-'.

    Hashes agree with other engines for ints, decimals and whole-second timestamps;
    doubles and sub-second timestamps render differently across engines, so avoid them."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))

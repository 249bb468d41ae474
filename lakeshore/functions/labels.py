"""Shared label expressions (the SQL-macro surface of a warehouse, as Column functions)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshore.functions.derive import ColumnOrName, _col

# Wetness thresholds and label texts.
LIGHT_RAIN_MAX_MM = 2.5
WETNESS_LABELS = ["snow", "unknown", "dry", "light rain", "heavy rain"]


def wetness_label(precipitation: ColumnOrName, snowfall: ColumnOrName,
                  light_max: float = LIGHT_RAIN_MAX_MM) -> Column:
    """Snow wins (snowfall > 0); then null precipitation is 'unknown', 0 is 'dry',
    up to ``light_max`` is 'light rain', above is 'heavy rain'. Null snowfall falls through."""
    p, s = _col(precipitation), _col(snowfall)
    return (
        F.when(s > 0, "snow")
        .when(p.isNull(), "unknown")
        .when(p == 0, "dry")
        .when(p <= light_max, "light rain")
        .otherwise("heavy rain")
    )

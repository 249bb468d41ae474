from lakeshore.functions.derive import (batch_month_for, either_in, elapsed, guarded_pct, hour_bucket,
                                        is_weekend, iso_day_of_week, month_key, positive_or_null, round_half_up)
from lakeshore.functions.keys import surrogate_key
from lakeshore.functions.labels import wetness_label

__all__ = [
    "batch_month_for",
    "either_in", "elapsed", "guarded_pct", "hour_bucket", "is_weekend",
    "iso_day_of_week", "month_key", "positive_or_null", "round_half_up", "surrogate_key",
    "wetness_label",
]

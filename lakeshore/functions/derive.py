"""Column-level derivations. Every function returns a Column, so it stays inside
whole-stage codegen and composes with any DataFrame."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnOrName, scale: int) -> Column:
    """Half-up rounding of a computed double, after dropping float noise below 1e-9
    (28.549999999999997 -> 28.55 -> 28.6), as decimal arithmetic would give. A chosen deviation:
    rounding the double itself would give 28.5 there."""
    return F.round(_col(c).cast("decimal(38,9)"), scale).cast("double")


def positive_or_null(c: ColumnOrName) -> Column:
    """Keep values > 0; zero, negatives and null become null (no ``otherwise``)."""
    c = _col(c)
    return F.when(c > 0, c)


def elapsed(start: ColumnOrName, end: ColumnOrName, unit_seconds: int = 60, scale: int = 2) -> Column:
    """Whole elapsed seconds (truncated, as ``timestampdiff`` does) expressed in ``unit_seconds``
    units and rounded half-up to ``scale`` decimals: 59 s -> 0.98 min, 21,601 s -> 360.02 min.
    Whole numbers throughout: half a unit is added to the magnitude, which is then cut."""
    seconds = F.timestamp_diff("SECOND", _col(start), _col(end))
    steps = F.floor((F.abs(seconds) * (2 * 10**scale) + unit_seconds) / (2 * unit_seconds))
    return F.when(seconds < 0, -steps).otherwise(steps) / F.lit(float(10**scale))


def hour_bucket(ts: ColumnOrName) -> Column:
    """Start of the hour as TIMESTAMP_NTZ. ``date_trunc`` goes through the session zone,
    which the session module pins to UTC, so the cast back is exact."""
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def guarded_pct(num: ColumnOrName, den: ColumnOrName, when: Column | None = None, scale: int = 2) -> Column:
    """``num / den * 100`` in double, only where ``den > 0`` (and ``when`` holds); else null."""
    num, den = _col(num), _col(den)
    cond = den > 0 if when is None else (when & (den > 0))
    return F.when(cond, round_half_up(num.cast("double") / den.cast("double") * 100, scale))


def either_in(values: Iterable, *cols: ColumnOrName) -> Column:
    """Three-valued "any of these ids is in the set": ``null or true`` is true,
    ``null or false`` stays null."""
    values = list(values)
    out = None
    for c in cols:
        hit = _col(c).isin(values)
        out = hit if out is None else (out | hit)
    return out


def month_key(ts: ColumnOrName) -> Column:
    """'yyyy-MM' batch key of a timestamp or date."""
    return F.date_format(_col(ts), "yyyy-MM")


def iso_day_of_week(ts: ColumnOrName) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(_col(ts)) + 1).cast("int")


def is_weekend(ts: ColumnOrName) -> Column:
    return F.weekday(_col(ts)) >= 5


def batch_month_for(run_date: ColumnOrName, delay_months: int = 2) -> Column:
    """First day of the batch month a run processes: the run date's month minus the
    publication delay (a run in May processes March)."""
    return F.add_months(F.trunc(_col(run_date), "MM"), -delay_months)

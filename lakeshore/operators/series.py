"""Array-shaped time series: documents holding parallel arrays (``time[i]`` belongs with
``field[i]``) become one row per instant, move from UTC to a local wall clock with real
daylight-saving rules, keep the hours of their own batch month, and merge the local hour
that occurs twice when clocks fall back.

One document = one row, so everything before the explode runs one task per document;
parallelism comes from many documents (months), which a multi-batch job has.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.functions.derive import ColumnOrName, _col, round_half_up

# Hourly archive field -> (silver column with its unit, type), and time format.
HOURLY_FIELDS = {
    "temperature_2m": ("temperature_c", T.DoubleType()),
    "precipitation": ("precipitation_mm", T.DoubleType()),
    "rain": ("rain_mm", T.DoubleType()),
    "snowfall": ("snowfall_cm", T.DoubleType()),
    "wind_speed_10m": ("wind_speed_kmh", T.DoubleType()),
    "weather_code": ("weather_code", T.IntegerType()),
}
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
SOURCE_ZONE = "GMT"

# How two readings of the same local hour combine (aggregate, decimals).
DST_MERGE = {
    "temperature_c": ("avg", 1),
    "precipitation_mm": ("sum", 1),
    "rain_mm": ("sum", 1),
    "snowfall_cm": ("sum", 2),
    "wind_speed_kmh": ("avg", 1),
    "weather_code": ("max", None),
}


def explode_series(docs: DataFrame, fields: Mapping[str, tuple[str, T.DataType]] = HOURLY_FIELDS,
                   path: str = "hourly", time_field: str = "time", keep: Sequence[str] = ("year", "month"),
                   time_format: str = TIME_FORMAT, time_col: str = "utc_time") -> DataFrame:
    """One row per array position: ``keep`` columns, the parsed instant (TIMESTAMP_NTZ, as
    written, no zone applied) and each field cast and renamed. Shorter arrays pad
    with null and documents without any reading give no row; check lengths first with :func:`validate_documents`.
    A time text that does not parse becomes null instead of failing the job."""
    series = F.col(path)
    longest = F.greatest(*[F.size(series[n]) for n in (time_field, *fields)], F.lit(0))
    position = F.sequence(F.lit(0), longest - 1)

    def reading(i: Column) -> Column:
        moment = F.try_to_timestamp(F.get(series[time_field], i), F.lit(time_format)).cast("timestamp_ntz")
        return F.struct(moment.alias(time_col), *[F.get(series[n], i).cast(kind).alias(to) for n, (to, kind) in fields.items()])

    return docs.where(longest > 0).select(*keep, F.inline(F.transform(position, reading)))


def to_local(utc_ntz: ColumnOrName, zone: str, source_zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` of a TIMESTAMP_NTZ that holds a ``source_zone`` reading.
    Independent of the session time zone. Two UTC hours may map to the same local hour."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), _col(utc_ntz))


def in_own_month(ts: ColumnOrName, year: str = "year", month: str = "month") -> Column:
    ts = _col(ts)
    return (F.year(ts) == F.col(year)) & (F.month(ts) == F.col(month))


def merge_duplicates(df: DataFrame, keys: Sequence[str], how: Mapping[str, tuple[str, int | None]] = DST_MERGE
                     ) -> DataFrame:
    """One row per key: each measure combined with its aggregate and rounded."""
    aggs = []
    for name, (fn, scale) in how.items():
        agg = getattr(F, fn)(name)
        aggs.append((round_half_up(agg, scale) if scale is not None else agg).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def local_hours(docs: DataFrame, zone: str, fields=HOURLY_FIELDS, keep=("year", "month"),
                hour_col: str = "weather_hour") -> DataFrame:
    """Documents -> one row per UTC reading with its local hour, only hours that fall inside
    the document's own (local) batch month."""
    rows = explode_series(docs, fields, keep=keep)
    return (rows.withColumn(hour_col, to_local("utc_time", zone))
            .filter(in_own_month(hour_col, *keep))
            .drop("utc_time"))


def flatten_series(docs: DataFrame, zone: str, fields=HOURLY_FIELDS, keep=("year", "month"),
                   how=DST_MERGE, hour_col: str = "weather_hour", date_col: str = "weather_date") -> DataFrame:
    """Documents -> silver hourly series: one row per local hour of each batch month."""
    hours = local_hours(docs, zone, fields, keep, hour_col)
    merged = merge_duplicates(hours, [*keep, hour_col], how)
    return merged.withColumn(date_col, F.to_date(hour_col))


def validate_documents(docs: DataFrame, fields: Sequence[str] = tuple(HOURLY_FIELDS), path: str = "hourly",
                       time_field: str = "time", zone_field: str = "timezone",
                       expected_zone: str = SOURCE_ZONE, required_nonnull: str = "temperature_2m",
                       year: str = "year", month: str = "month") -> DataFrame:
    """One row per document with its checks (over **all** documents, not the first):
    hours present, hours expected ((days in month + 1) x 24 UTC hours), equal array
    lengths, nulls in the required field, time zone as expected, and ``valid``."""
    known = docs.select(f"{path}.*").columns        # schema metadata, no job
    names = (time_field, *fields)
    missing = [f for f in names if f not in known]
    # a field the document leaves out reads as null, whatever the schema says
    left_out = F.filter(F.array(*[F.lit(f) if f in missing else F.when(F.col(f"{path}.{f}").isNull(), f) for f in names]),
                        lambda f: f.isNotNull())
    n = F.size(F.col(f"{path}.{time_field}"))
    start = F.make_date(F.col(year), F.col(month), F.lit(1))
    expected = ((F.datediff(F.last_day(start), start) + 2) * 24).cast("int")
    present = [f for f in fields if f not in missing]
    equal = F.lit(True)
    for f in present:
        equal = equal & (F.col(f"{path}.{f}").isNull() | (F.size(F.col(f"{path}.{f}")) == n))
    has_nulls = (F.coalesce(F.exists(F.col(f"{path}.{required_nonnull}"), lambda x: x.isNull()), F.lit(True))
                 if required_nonnull in present else F.lit(True))
    checked = docs.select(
        year, month,
        F.when(F.size(left_out) > 0, F.array_join(left_out, ",")).alias("missing_fields"),
        n.cast("int").alias("n_hours"),
        expected.alias("expected_hours"),
        equal.alias("equal_lengths"),
        has_nulls.alias("has_null_required"),
        (F.col(zone_field) == expected_zone).alias("zone_ok"),
    )
    return checked.withColumn(
        "valid",
        F.col("missing_fields").isNull() & (F.col("n_hours") == F.col("expected_hours"))
        & F.col("equal_lengths") & ~F.col("has_null_required") & F.coalesce(F.col("zone_ok"), F.lit(False)),
    )


def expected_local_hours(months: DataFrame, zone: str, year: str = "year", month: str = "month") -> DataFrame:
    """Distinct local wall-clock hours that exist in each (year, month) in ``zone``: a
    generated UTC spine around the month, converted, kept inside the month. 743 for a
    spring-forward March in New York, 720 for November (its doubled 01:00 counts once)."""
    start = F.make_date(F.col(year), F.col(month), F.lit(1)).cast("timestamp_ntz")
    spine = F.sequence(F.timestamp_add("DAY", F.lit(-1), start),
                       F.timestamp_add("DAY", F.lit(1), F.add_months(start, 1).cast("timestamp_ntz")),
                       F.expr("INTERVAL 1 HOUR"))
    local = (months.select(year, month, F.explode(spine).alias("u"))
             .select(year, month, to_local("u", zone).alias("h"))
             .filter(in_own_month("h", year, month)))
    return local.groupBy(year, month).agg(F.count_distinct("h").alias("expected_hours"))


def month_completeness(series: DataFrame, zone: str, hour_col: str = "weather_hour",
                       required_nonnull: str = "temperature_c", year: str = "year", month: str = "month",
                       tolerance: int = 1) -> DataFrame:
    """Per batch month: hours held, calendar hours (days x 24), hours that exist locally,
    hours lacking the required measure; ``within_tolerance`` is the loose check
    (|held - calendar| <= tolerance), ``complete`` the strict one (held = existing, no nulls)."""
    held = series.groupBy(year, month).agg(
        F.count("*").alias("hours"),
        F.count_if(F.col(required_nonnull).isNull()).alias("null_required_hours"),
    )
    start = F.make_date(F.col(year), F.col(month), F.lit(1))
    calendar = (F.dayofmonth(F.last_day(start)) * 24).cast("int")
    exp = expected_local_hours(held.select(year, month), zone, year, month)
    return (
        held.join(exp, [year, month], "left")
        .withColumn("calendar_hours", calendar)
        .withColumn("within_tolerance", F.abs(F.col("hours") - F.col("calendar_hours")) <= tolerance)
        .withColumn("complete", (F.col("hours") == F.col("expected_hours")) & (F.col("null_required_hours") == 0))
    )

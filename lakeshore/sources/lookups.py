"""Code lookups: typed CSV reading, and the small fixed code lists of the trip domain.

Lookups are bounded by construction (a code list does not grow with the facts), which is
what makes a broadcast of them safe at any data size.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Payment type codes and names.
PAYMENT_TYPES = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# Final rate codes and names.
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
]

# WMO weather interpretation codes, description, broad category.
WEATHER_CODES = [
    (0, "Clear sky", "clear"),
    (1, "Mainly clear", "clear"),
    (2, "Partly cloudy", "cloudy"),
    (3, "Overcast", "cloudy"),
    (45, "Fog", "fog"),
    (48, "Depositing rime fog", "fog"),
    (51, "Light drizzle", "drizzle"),
    (53, "Moderate drizzle", "drizzle"),
    (55, "Dense drizzle", "drizzle"),
    (56, "Light freezing drizzle", "drizzle"),
    (57, "Dense freezing drizzle", "drizzle"),
    (61, "Slight rain", "rain"),
    (63, "Moderate rain", "rain"),
    (65, "Heavy rain", "rain"),
    (66, "Light freezing rain", "rain"),
    (67, "Heavy freezing rain", "rain"),
    (71, "Slight snowfall", "snow"),
    (73, "Moderate snowfall", "snow"),
    (75, "Heavy snowfall", "snow"),
    (77, "Snow grains", "snow"),
    (80, "Slight rain showers", "rain"),
    (81, "Moderate rain showers", "rain"),
    (82, "Violent rain showers", "rain"),
    (85, "Slight snow showers", "snow"),
    (86, "Heavy snow showers", "snow"),
    (95, "Thunderstorm", "thunderstorm"),
    (96, "Thunderstorm with slight hail", "thunderstorm"),
    (99, "Thunderstorm with heavy hail", "thunderstorm"),
]

for _codes in (PAYMENT_TYPES, RATE_CODES, WEATHER_CODES):   # fixed lists: keys unique by construction
    assert len({row[0] for row in _codes}) == len(_codes)

PAYMENT_DDL = "payment_type int, payment_type_name string"
RATE_DDL = "ratecode_id int, ratecode_name string"
WEATHER_CODE_DDL = "weather_code int, weather_description string, weather_category string"
ZONE_DDL = "location_id int, borough string, zone string, service_zone string"


def inline(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A fixed list as an inline VALUES relation: a local relation whose exact (tiny) size the
    planner knows, so joins against it are planned as broadcasts even before any hint."""
    fields = [f.strip().split(None, 1) for f in ddl.split(",")]

    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"`{n}`" for n, _ in fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})").select(
        *[F.col(f"`{n}`").cast(t).alias(n) for n, t in fields])


def payment_types(spark: SparkSession) -> DataFrame:
    return inline(spark, PAYMENT_TYPES, PAYMENT_DDL)


def rate_codes(spark: SparkSession) -> DataFrame:
    return inline(spark, RATE_CODES, RATE_DDL)


def weather_codes(spark: SparkSession) -> DataFrame:
    return inline(spark, WEATHER_CODES, WEATHER_CODE_DDL)


def read_lookup_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Header CSV with a fixed schema (no inference). Quoted text such as 'N/A' stays text;
    only empty fields are null."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").schema(ddl).csv(path))


def write_lookup_csv(df: DataFrame, path: str) -> None:
    """One quoted-text CSV with header (a lookup is small: one file is the right size)."""
    (df.coalesce(1).write.mode("overwrite").option("header", True)
     .option("quoteAll", True).csv(path))

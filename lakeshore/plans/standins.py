"""Stand-ins: the driver's TPC-H-like tables re-shaped into the inputs of the trip/weather
pipeline. Each is a lazy plan over the given tables, so its work grows with them.

The same expressions are written as SQL in ``lakeshore.plans.oracle``; keep both in step.

trips      lineitem join orders: pickup = order date + line number hours and some minutes, a ride
           of 2 to 92 minutes from the keys, money from prices; nulls, rides that end before they
           start, too short, too long and too far ones come from key arithmetic (a few per cent each).
           Batch (landing) month = month of (order date - 1 day): orders of the first day of a
           month land in the previous month's batch and break pickup_outside_month.
zones      nation join region (location_id = nation key).
weather    one UTC hour per hour of the calendar months the orders span; measures are
           arithmetic of the hour number and of the events of that day and hour of a month.
holidays   per order month: the busiest day (nationwide), the highest-value day (regional,
           listed in codes built from order status), the quietest day (flags unknown).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshore.plans.trips import TripParams
from lakeshore.sources.batches import spread
from lakeshore.sources.tables import table

STANDIN_AIRPORT_ZONES = (1, 13, 24)
STANDIN_TRIPS = TripParams(airport_zones=STANDIN_AIRPORT_ZONES)
STANDIN_REGION_CODE = "US-P"     # the "home region" used by the holiday filter
LOCAL_ZONE = "America/New_York"


def _null_when(cond, value):
    return F.when(~cond, value)


def raw_trips(spark: SparkSession, root: str, by_batch: bool = False) -> DataFrame:
    """Bronze-shaped trips (raw column names, mixed raw types) with batch columns year, month. ``by_batch`` arranges them
    for a write by batch (``files_per_batch=0``) before their columns are computed, on rows of a third of the width."""
    li = table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # orders grows with lineitem (a quarter of its rows): never a broadcast side at scale.
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    batch_day = F.date_sub(F.col("o_orderdate"), 1)
    if by_batch:
        j = spread(j.drop("o_orderkey").withColumn("__batch", F.trunc(batch_day, "MM")), ["__batch"])
    pickup = F.timestamp_add("MINUTE", F.col("l_linenumber") * 60 + F.col("l_partkey") % 60, F.col("o_orderdate"))
    seconds = (F.when(F.col("l_orderkey") % 43 == 0, F.lit(-300)).when(F.col("l_orderkey") % 47 == 0, F.lit(20))
               .when(F.col("l_orderkey") % 59 == 0, F.lit(43200))
               .otherwise(F.lit(120) + (F.col("l_partkey") * 37 + F.col("l_linenumber") * 11) % 5400))
    miles = (F.when(F.col("l_orderkey") % 83 == 0, F.lit(0.0)).when(F.col("l_orderkey") % 79 == 0, F.col("l_quantity") + 150)
             .otherwise(F.col("l_quantity") / 2))
    return j.select(
        F.col("l_suppkey").alias("VendorID"),
        _null_when(F.col("l_partkey") % 101 == 0, pickup).alias("tpep_pickup_datetime"),
        _null_when(F.col("l_partkey") % 103 == 0, F.timestamp_add("SECOND", seconds, pickup)).alias("tpep_dropoff_datetime"),
        _null_when(F.col("l_orderkey") % 53 == 0,
                   (F.col("l_linenumber") - 2).cast("double")).alias("passenger_count"),
        _null_when(F.col("l_partkey") % 89 == 0, miles).alias("trip_distance"),
        (F.col("l_partkey") % 7 + 1).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
        _null_when(F.col("o_custkey") % 97 == 0, F.col("o_custkey") % 25).alias("PULocationID"),
        (F.col("l_suppkey") % 25).alias("DOLocationID"),
        (F.col("l_partkey") % 5).alias("payment_type"),
        _null_when(F.col("l_orderkey") % 61 == 0, F.col("l_extendedprice") - 3000).alias("fare_amount"),
        (F.col("l_discount") * 10).alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.when(F.col("l_partkey") % 5 == 1, F.col("l_discount") * 100).otherwise(F.lit(0.0)).alias("tip_amount"),
        (F.col("l_tax") * 10).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        ((F.col("l_extendedprice") - 2990) + F.col("l_discount") * 100).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.when((F.col("l_suppkey") % 25).isin(*STANDIN_AIRPORT_ZONES), F.lit(1.75))
         .otherwise(F.lit(0.0)).alias("Airport_fee"),
        F.year(batch_day).alias("year"),
        F.month(batch_day).alias("month"),
    )


def zones(spark: SparkSession, root: str) -> DataFrame:
    """Zone lookup (location_id, borough, zone, service_zone) from nation and region."""
    n = table(spark, root, "nation")
    r = table(spark, root, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("Zone "), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )


def order_month_span(spark: SparkSession, root: str) -> DataFrame:
    """One row: first and last calendar month touched by the orders."""
    o = table(spark, root, "orders")
    return o.agg(
        F.trunc(F.min("o_orderdate"), "MM").alias("first_month"),
        F.trunc(F.max("o_orderdate"), "MM").alias("last_month"),
    )


def weather_months(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, month_start date) for every calendar month of the orders' span."""
    span = order_month_span(spark, root)
    return span.select(
        F.explode(F.sequence("first_month", "last_month", F.expr("INTERVAL 1 MONTH"))).alias("month_start")
    ).select(F.year("month_start").alias("year"), F.month("month_start").alias("month"), "month_start")


def event_load(spark: SparkSession, root: str) -> DataFrame:
    """(slot, load) of every hour of a month (day and hour of day) in which events fell: their number
    and summed value, as one whole number. What the weather readings are made of."""
    e = table(spark, root, "events")
    slot = (F.dayofmonth("ts") - 1) * 24 + F.hour("ts")
    cents = F.round(F.col("value") * 100).cast("bigint")
    return e.groupBy(slot.alias("slot")).agg((F.count(F.lit(1)) * 7 + F.coalesce(F.sum(cents), F.lit(0))).alias("load"))


def hour_measures(n):
    """Weather of an hour from a whole number: its hour number plus the events' load."""
    temp = F.round((n * 37) % 400 / 10.0 - 10.0, 1)
    wet = (n * 13) % 70 / 10.0 - 2.0
    precip = F.when(n % 11 == 0, F.lit(None).cast("double")).when(wet > 0, F.round(wet, 1)).otherwise(F.lit(0.0))
    snow = F.when((temp < 0) & (precip > 0), F.round(precip * 0.7, 2)).otherwise(F.lit(0.0))
    rain = F.when(temp >= 0, precip).otherwise(F.lit(0.0))
    wind = F.round((n * 17) % 300 / 10.0, 1)
    code = (F.when(snow > 0, 71).when(precip > 2.5, 63).when(precip > 0, 61).otherwise(n % 4)).cast("int")
    return {"temperature_2m": temp, "precipitation": precip, "rain": rain,
            "snowfall": snow, "wind_speed_10m": wind, "weather_code": code}


WEATHER_FIELDS = ("temperature_2m", "precipitation", "rain", "snowfall", "wind_speed_10m", "weather_code")


def weather_documents(spark: SparkSession, root: str) -> DataFrame:
    """One document per UTC month: hours from the 1st 00:00 to the 1st of the next month
    23:00 (one extra day), as parallel arrays, like a downloaded hourly-archive response. An hour's
    readings come from the events of the same day and hour of a month; hours are collected and
    sorted into arrays per month (some 770 rows each)."""
    months = weather_months(spark, root).repartition("month_start")
    start = F.col("month_start").cast("timestamp_ntz")
    end = F.timestamp_add("HOUR", F.lit(23), F.add_months("month_start", 1).cast("timestamp_ntz"))
    hours = months.select("year", "month", F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias("at"))
    slot = (F.dayofmonth("at") - 1) * 24 + F.hour("at")
    loaded = hours.withColumn("slot", slot).join(event_load(spark, root), "slot", "left")   # 744 slots at most
    number = F.floor(F.unix_timestamp(F.col("at").cast("timestamp")) / 3600) + F.coalesce("load", F.lit(0))
    m = hour_measures(F.col("n"))
    readings = loaded.withColumn("n", number).select("year", "month", F.struct(
        F.date_format("at", "yyyy-MM-dd'T'HH:mm").alias("time"), *[m[n].alias(n) for n in WEATHER_FIELDS]).alias("reading"))
    docs = readings.groupBy("year", "month").agg(F.sort_array(F.collect_list("reading")).alias("r"))

    def field(name):
        return lambda r: r[name]

    return docs.select(
        "year", "month",
        F.lit("GMT").alias("timezone"),
        F.struct(*[F.transform("r", field(n)).alias(n) for n in ("time", *WEATHER_FIELDS)]).alias("hourly"),
    )


# Months whose documents are broken, and how (for the checks to find).
WRONG_ZONE_MONTH, SHORT_ARRAY_MONTH, NULL_READING_MONTH, LOST_FIELD_MONTH = 5, 7, 9, 11


def broken_documents(docs: DataFrame) -> DataFrame:
    """The documents with faults: another zone, an array cut short, a reading without temperature,
    a field left out."""
    h, month = F.col("hourly"), F.col("month")
    series = {n: h[n] for n in ("time", *WEATHER_FIELDS)}
    series["precipitation"] = F.when(month == SHORT_ARRAY_MONTH, F.slice(h["precipitation"], 1, 100)).otherwise(h["precipitation"])
    series["temperature_2m"] = F.when(month == NULL_READING_MONTH, F.transform(
        h["temperature_2m"], lambda v, i: F.when(i != 5, v))).otherwise(h["temperature_2m"])
    series["snowfall"] = F.when(month != LOST_FIELD_MONTH, h["snowfall"])
    return docs.select("year", "month", F.when(month == WRONG_ZONE_MONTH, LOCAL_ZONE).otherwise(F.col("timezone")).alias("timezone"),
                       F.struct(*[v.alias(n) for n, v in series.items()]).alias("hourly"))


def daily_orders(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n_orders"),
        F.sum("o_totalprice").alias("value"),
        F.sort_array(F.collect_set(F.concat(F.lit("US-"), F.col("o_orderstatus")))).alias("codes"),
    )


def holiday_records(spark: SparkSession, root: str) -> DataFrame:
    """JSON-shaped holiday records (date string, name, localName, global, counties, types)."""
    d = daily_orders(spark, root).withColumn("ym", F.date_format("day", "yyyy-MM"))
    by_month = Window.partitionBy("ym")
    ranked = (
        d.withColumn("r_busy", F.row_number().over(by_month.orderBy(F.desc("n_orders"), "day")))
        .withColumn("r_value", F.row_number().over(by_month.orderBy(F.desc("value"), "day")))
        .withColumn("r_quiet", F.row_number().over(by_month.orderBy("n_orders", "day")))
    )
    nullstr = F.lit(None).cast("array<string>")
    busy = ranked.filter("r_busy = 1").select(
        F.date_format("day", "yyyy-MM-dd").alias("date"), F.lit("Busy Day").alias("name"),
        F.concat(F.lit("Busy Day "), F.col("ym")).alias("localName"), F.lit(True).alias("global"),
        nullstr.alias("counties"), F.array(F.lit("Public")).alias("types"))
    value = ranked.filter("r_value = 1").select(
        F.date_format("day", "yyyy-MM-dd").alias("date"), F.lit("Value Day").alias("name"),
        F.concat(F.lit("Value Day "), F.col("ym")).alias("localName"), F.lit(False).alias("global"),
        F.col("codes").alias("counties"), F.array(F.lit("Observance"), F.lit("Optional")).alias("types"))
    quiet = ranked.filter("r_quiet = 1").select(
        F.date_format("day", "yyyy-MM-dd").alias("date"), F.lit("Quiet Day").alias("name"),
        F.lit(None).cast("string").alias("localName"), F.lit(None).cast("boolean").alias("global"),
        nullstr.alias("counties"), nullstr.alias("types"))
    return busy.unionByName(value).unionByName(quiet)


def broken_records(records: DataFrame) -> DataFrame:
    """Holiday records with their batch year, some faulty by their month: no calendar date, the wrong year, an
    empty name, no name; the records of one year are missing altogether."""
    day = F.to_date("date")
    month, year = F.month(day), F.year(day)
    text = (F.when(month == 2, F.concat(F.substring("date", 1, 5), F.lit("02-30")))
            .when(month == 4, F.date_format(F.add_months(day, 12), "yyyy-MM-dd")).otherwise(F.col("date")))
    name = F.when(month == 6, "").when(month != 8, F.col("name"))
    return records.select(year.alias("year"), text.alias("date"), name.alias("name")).where(F.col("year") != EMPTY_YEAR)


EMPTY_YEAR = 1997


# History runs of the customer table (a slowly changing lookup). Every customer is in every
# snapshot unless the scenario says otherwise:
#   v1  as loaded; accounts in debt (balance < 0) have no segment yet;
#   v2  debt accounts get their segment (null -> value), balances above 9000 are re-segmented
#       'PREMIUM' (change), the customers of nation 7 leave (hard delete), the customers of
#       nation 3 open a second account under a new key (insert);
#   v3  as v2, and the nation-7 customers come back (re-appearance).
HISTORY_RUNS = ("2024-01-01 00:00:00", "2024-01-11 00:00:00", "2024-01-21 00:00:00")
HISTORY_KEY = ["c_custkey"]
HISTORY_CHECK = ["c_name", "c_nationkey", "c_mktsegment"]
INSERTED_KEY_OFFSET = 10_000_000
LEAVING_NATION, EXPANDING_NATION = 7, 3
PREMIUM_BALANCE = 9000


def customer_versions(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    v1 = c.withColumn("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))).select(*cols)
    current = c.withColumn("c_mktsegment", F.when(F.col("c_acctbal") > PREMIUM_BALANCE, F.lit("PREMIUM"))
                           .otherwise(F.col("c_mktsegment")))
    staying = current.filter(F.col("c_nationkey") != LEAVING_NATION).select(*cols)
    opened = (c.filter(F.col("c_nationkey") == EXPANDING_NATION)
              .withColumn("c_custkey", F.col("c_custkey") + INSERTED_KEY_OFFSET).select(*cols))
    v2 = staying.unionByName(opened)
    v3 = v2.unionByName(v1.filter(F.col("c_nationkey") == LEAVING_NATION))
    return v1, v2, v3

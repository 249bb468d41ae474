"""Contract and quarantine rules with the literal edge rows of the trip domain."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshore.operators.contract import ContractError, Field, conform, schema_drift, unexpected_columns
from lakeshore.operators.rules import first_broken_rule, reason_histogram, split, split_counts, with_reason
from lakeshore.plans.trips import TAXI, TRIP_CONTRACT, clean_trips, derive_trip, trip_rules

D = dt.datetime


def raw_row(pickup, dropoff, fare="10.00", total="12.00", distance=1.5, passengers=1.0, pu=5, do=6, pay=1,
            tip="1.00", year=2025, month=1):
    return {"VendorID": 1, "tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff,
            "passenger_count": passengers, "trip_distance": distance, "RatecodeID": 1.0,
            "store_and_fwd_flag": "N", "PULocationID": pu, "DOLocationID": do, "payment_type": pay,
            "fare_amount": None if fare is None else float(fare), "extra": 0.5, "mta_tax": 0.5,
            "tip_amount": float(tip), "tolls_amount": 0.0, "improvement_surcharge": 1.0,
            "total_amount": None if total is None else float(total), "congestion_surcharge": 2.5,
            "airport_fee": 0.0, "year": year, "month": month}


RAW_DDL = ("VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
           "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
           "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, extra double, "
           "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
           "total_amount double, congestion_surcharge double, airport_fee double, year int, month int")

P0 = D(2025, 1, 15, 10, 0, 0)
EDGE = [
    ("59s", raw_row(P0, P0 + dt.timedelta(seconds=59)), "too_short"),
    ("60s", raw_row(P0, P0 + dt.timedelta(seconds=60)), None),
    ("360min", raw_row(P0, P0 + dt.timedelta(minutes=360)), None),
    ("21601s", raw_row(P0, P0 + dt.timedelta(seconds=21601)), "too_long"),
    ("equal", raw_row(P0, P0), "too_short"),
    ("backwards", raw_row(P0, P0 - dt.timedelta(minutes=5)), "dropoff_before_pickup"),
    ("null_pickup", raw_row(None, P0), "missing_timestamp"),
    ("prev_month", raw_row(D(2024, 12, 31, 23, 50), D(2025, 1, 1, 0, 10)), "pickup_outside_month"),
    ("next_month_dropoff", raw_row(D(2025, 1, 31, 23, 50), D(2025, 2, 1, 0, 10)), None),
    ("negative_fare", raw_row(P0, P0 + dt.timedelta(minutes=10), fare="-5.00"), "negative_amount"),
    ("null_fare", raw_row(P0, P0 + dt.timedelta(minutes=10), fare=None), None),
    ("100mi", raw_row(P0, P0 + dt.timedelta(minutes=100), distance=100.0), None),
    ("100.01mi", raw_row(P0, P0 + dt.timedelta(minutes=100), distance=100.01), "too_far"),
    ("null_distance", raw_row(P0, P0 + dt.timedelta(minutes=10), distance=None), None),
    ("three_rules", raw_row(D(2024, 12, 31, 23, 0), D(2024, 12, 31, 22, 0), fare="-1.00", distance=500.0),
     "pickup_outside_month"),
]


def test_first_broken_rule_priority(spark):
    raw = spark.createDataFrame([(n, *r.values()) for n, r, _ in EDGE], "case string, " + RAW_DDL)
    conformed = conform(raw, TAXI.contract, keep=["case", "year", "month"])
    out = with_reason(derive_trip(conformed, TAXI), trip_rules(TAXI))
    got = {r.case: r.reject_reason for r in out.select("case", "reject_reason").collect()}
    assert got == {n: exp for n, _, exp in EDGE}


def test_passenger_and_airport_derivations(spark):
    rows = [raw_row(P0, P0 + dt.timedelta(minutes=10), passengers=p, pu=pu, do=do)
            for p, pu, do in [(0.0, None, 132), (-1.0, None, 7), (None, 1, None), (2.0, 3, 4)]]
    out = clean_trips(spark.createDataFrame(rows, RAW_DDL), TAXI).select("passenger_count", "is_airport_trip").collect()
    assert [tuple(r) for r in out] == [(None, True), (None, None), (None, True), (2, False)]


def test_split_is_a_partition(spark):
    raw = spark.createDataFrame([r for _, r, _ in EDGE], RAW_DDL)
    df = clean_trips(raw, TAXI)
    ok, bad = split(df)
    assert ok.count() + bad.count() == raw.count()
    assert "reject_reason" not in ok.columns and bad.filter("reject_reason IS NULL").count() == 0
    c = split_counts(df).first()
    assert c.reconciled and c.input_rows == len(EDGE)
    hist = reason_histogram(df).collect()
    assert hist[0].n_rows >= hist[-1].n_rows


def test_conform_case_insensitive_defaults_and_errors(spark):
    raw = spark.createDataFrame([(1, "2.50", 7)], "vendorid int, AIRPORT_FEE string, extra_col int")
    contract = [Field("vendor_id", "VendorID", "int"), Field("airport_fee", "Airport_fee", "decimal(12,2)"),
                Field("cbd_congestion_fee", "cbd_congestion_fee", "decimal(12,2)", default=0)]
    out = conform(raw, contract)
    assert out.columns == ["vendor_id", "airport_fee", "cbd_congestion_fee"]
    assert tuple(out.first()) == (1, Decimal("2.50"), Decimal("0.00"))
    assert unexpected_columns(raw.columns, contract) == ["extra_col"]
    with pytest.raises(ContractError):
        conform(raw, contract + [Field("x", "not_there", "int")])


def test_conform_try_cast_option(spark):
    raw = spark.createDataFrame([("12",), ("oops",)], "VendorID string")
    out = conform(raw, [Field("vendor_id", "VendorID", "int")], on_cast="null")
    assert [r[0] for r in out.collect()] == [12, None]


def test_schema_drift_report(spark):
    rows = [("2025-01", "VendorID", "int", 0), ("2025-01", "Airport_fee", "double", 1),
            ("2025-02", "VendorID", "bigint", 0), ("2025-02", "airport_fee", "double", 1)]
    rep = schema_drift(spark.createDataFrame(rows, "period string, column string, type string, position int"))
    got = {(r.column, r.period): (r.type, r.differs, r.spellings) for r in rep.collect()}
    assert got[("VendorID", "2025-02")] == ("bigint", True, None)
    assert got[("Airport_fee", "2025-02")] == ("MISSING", True, "Airport_fee,airport_fee")
    assert len(got) == 6


def test_first_broken_rule_null_condition_is_not_broken(spark):
    df = spark.createDataFrame([(None,), (-1,)], "x int")
    out = df.select(first_broken_rule([("neg", F.col("x") < 0)])).collect()
    assert [r[0] for r in out] == [None, "neg"]


def test_trip_contract_order():
    assert [f.target for f in TRIP_CONTRACT][:3] == ["vendor_id", "pickup_datetime", "dropoff_datetime"]
    assert len(TRIP_CONTRACT) == 20

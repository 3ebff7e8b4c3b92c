"""Scalar rules on hand-written edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkelt import schemas as S
from sparkelt.functions import columns as C
from sparkelt.plans.models import DIMENSIONS


def apply(spark, ddl, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("o")).collect()]


def test_code_clean(spark):
    got = apply(spark, "bigint", [None, 0, 1, 6, 7, 99, -1], C.code_clean("v"))
    assert got == [-1, -1, 1, 6, -1, -1, -1]


def test_positive_flag(spark):
    got = apply(spark, "bigint", [None, -1, 0, 1], C.positive_flag("v"))
    assert got == ["missing", "invalid", "invalid", "valid"]


def test_amount_flag(spark):
    got = apply(spark, "double", [None, -0.01, 0.0, -0.0, 0.01], C.amount_flag("v"))
    assert got == ["missing", "invalid", "zero", "zero", "valid"]


def test_enum_flag(spark):
    got = apply(spark, "bigint", [None, 0, 1, 2, 3], C.enum_flag("v", S.TRIP_TYPES))
    assert got == ["missing", "invalid", "valid", "valid", "invalid"]


@pytest.mark.parametrize(
    "key, labels, default",
    [
        ("dim_vendor", S.VENDOR_LABELS, S.VENDOR_DEFAULT),
        ("dim_payment", S.PAYMENT_LABELS, S.PAYMENT_DEFAULT),
        ("dim_ratecode", S.RATECODE_LABELS, S.RATECODE_DEFAULT),
        ("dim_trip_type", S.TRIP_TYPE_LABELS, S.TRIP_TYPE_DEFAULT),
    ],
)
def test_labels(spark, key, labels, default):
    codes = [*labels, -1, 99, None]
    got = apply(spark, "bigint", codes, DIMENSIONS[key].title("v"))
    assert got == [*labels.values(), default, default, default]


def test_location_name_pads_and_truncates(spark):
    got = apply(spark, "bigint", [1, 42, 265, 1000], C.location_name("v"))
    assert got == ["Location 001", "Location 042", "Location 265", "Location 100"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_time_rules_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        start = datetime(2024, 3, 10, 1, 59, 45)  # across a New York clock change
        df = spark.range(1).select(F.lit("2024-03-10 01:59:45").cast("timestamp_ntz").alias("p"))
        for seconds, minutes in [(29, 0), (30, 1), (90, 2), (630, 11), (7200, 120)]:
            end = F.expr(f"p + INTERVAL '{seconds}' SECOND")
            assert df.select(C.trip_duration(F.col("p"), end)).first()[0] == minutes
        assert df.select(C.iso_seconds("p")).first()[0] == start.isoformat()
        night = [("21:59:59", 0), ("22:00:00", 1), ("05:59:59", 1), ("06:00:00", 0), ("02:30:00", 1)]
        for clock, flag in night:
            at = F.lit(f"2024-03-10 {clock}").cast("timestamp_ntz")
            assert df.select(C.night_flag(at)).first()[0] == flag
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_flags_of_missing_time_are_zero(spark):
    nothing = F.lit(None).cast("timestamp_ntz")
    row = spark.range(1).select(C.night_flag(nothing), C.weekend_flag(nothing)).first()
    assert tuple(row) == (0, 0)


def test_weekend(spark):
    days = [datetime(2024, 1, d, 12) for d in (5, 6, 7, 8)]  # Friday to Monday
    assert apply(spark, "timestamp_ntz", days, C.weekend_flag("v")) == [0, 1, 1, 0]


def test_parse_timestamp(spark):
    texts = ["2024-01-05T10:00:00", "2024-01-05 10:00:00.25", "junk", None]
    got = apply(spark, "string", texts, C.parse_timestamp("v"))
    assert got == [datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 10, 0, 0, 250000), None, None]


def test_trip_key_skips_nulls(spark):
    df = spark.createDataFrame([(None, "b", 3)], "a bigint, b string, c bigint")
    want = spark.range(1).select(F.sha2(F.lit("green||b||3"), 256)).first()[0]
    assert df.select(C.trip_key("green", ["a", "b", "c"])).first()[0] == want


def test_trip_key_writes_fractions_only_when_present(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 5, 10, 0, 0, 500000),)], "t timestamp_ntz")
    want = spark.range(1).select(F.sha2(F.lit("green||2024-01-05 10:00:00.5"), 256)).first()[0]
    assert df.select(C.trip_key("green", ["t"])).first()[0] == want

"""Filters, deduplication, union and gate on hand-written rows."""

from datetime import datetime

import pytest

from sparkelt import schemas as S
from sparkelt.operators.dedup import dedup_latest
from sparkelt.operators.filters import drop_invalid, quality_gate, since, since_marks
from sparkelt.operators.profile import preview, profile
from sparkelt.plans import models as M

PICKUP = datetime(2024, 1, 5, 10, 0)


def raw_green(spark, rows):
    return spark.createDataFrame(rows, S.GREEN.raw_schema)


def test_drop_invalid(spark, trip_row):
    bad = [
        trip_row(trip_id=None),
        trip_row(VendorID=None),
        trip_row(lpep_pickup_datetime=None),
        trip_row(lpep_dropoff_datetime=None),
        trip_row(PULocationID=None),
        trip_row(DOLocationID=None),
        trip_row(lpep_dropoff_datetime=PICKUP),
        trip_row(lpep_dropoff_datetime=datetime(2024, 1, 5, 9, 59)),
    ]
    kept = drop_invalid(raw_green(spark, [*bad, trip_row()]), S.GREEN).collect()
    assert [tuple(r) for r in kept] == [trip_row()]


def test_dedup_keeps_the_newest_then_the_greatest_tiebreak(spark):
    rows = [("a", 1, 5.0), ("a", 2, 1.0), ("b", 3, None), ("b", 3, 4.0), ("b", 3, 2.0), (None, 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = dedup_latest(df, ["k"], ["t"], ["v"]).collect()
    assert {tuple(r) for r in got} == {("a", 2, 1.0), ("b", 3, 4.0), (None, 1, 1.0)}


def test_staging_schema_is_as_declared(spark, sf_dir):
    from sparkelt.fixtures import raw_feed

    for feed in S.FEEDS.values():
        raw = raw_feed(spark, sf_dir, feed)
        assert raw.schema.simpleString() == feed.raw_schema.simpleString()
        got = M.stg_taxi(raw, feed).schema.simpleString()
        assert got == S.staging_schema(feed).simpleString()
    assert [len(S.staging_schema(f)) for f in (S.GREEN, S.YELLOW)] == [35, 33]
    assert [len(s) for s in (S.INT_BOTH_SCHEMA, S.INT_METRICS_SCHEMA, S.FACT_SCHEMA)] == [23, 26, 25]


@pytest.mark.parametrize("flag", S.GATE_FLAGS)
def test_gate_looks_at_every_flag(spark, flag):
    values = ["missing", "invalid", "zero", "valid", "not_applicable", None]
    rows = [tuple(v if f == flag else "valid" for f in S.GATE_FLAGS) for v in values]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in S.GATE_FLAGS))
    assert [r[flag] for r in quality_gate(df).collect()] == ["zero", "valid", "not_applicable"]


def test_union_aligns_what_a_feed_lacks(spark, sf_dir):
    from sparkelt.fixtures import raw_feed

    green, yellow = (M.stg_taxi(raw_feed(spark, sf_dir, f), f) for f in S.FEEDS.values())
    both = M.int_both_taxi(green, yellow)
    assert both.schema.simpleString() == S.INT_BOTH_SCHEMA.simpleString()
    own = both.select("taxi_type", "airport_fee", "ehail_fee", "trip_type").distinct()
    assert own.filter("taxi_type = 'green' AND airport_fee <> 0").isEmpty()
    assert own.filter("taxi_type = 'yellow' AND (ehail_fee <> 0 OR trip_type <> 1)").isEmpty()
    counts = {r[0]: r[1] for r in both.groupBy("taxi_type").count().collect()}
    assert sf_dir != "/root/testdata/sf0.001" or counts == {"green": 851, "yellow": 1806}


def test_a_feed_that_never_fills_its_fee_does_not_pass(spark, trip_row):
    staged = M.stg_taxi(raw_green(spark, [trip_row(ehail_fee=None)]), S.GREEN)
    yellow = spark.createDataFrame([], S.staging_schema(S.YELLOW))
    assert staged.first()["ehail_fee_flag"] == "missing"
    assert M.int_both_taxi(staged, yellow).isEmpty()


def test_since_is_strict_and_open_without_a_mark(spark):
    rows = [("green", datetime(2024, 2, 1, h)) for h in (1, 2, 3)] + [("yellow", datetime(2024, 2, 1, 1))]
    df = spark.createDataFrame(rows, "taxi_type string, loaded_at timestamp_ntz")
    mark = datetime(2024, 2, 1, 2)
    assert [r.loaded_at.hour for r in since(df, mark).collect()] == [3]
    assert since(df, None).count() == 4
    assert since_marks(df, {"green": mark, "yellow": None}).count() == 2
    assert since_marks(df, {"green": mark, "yellow": mark}).count() == 1
    assert since_marks(df, {"green": None, "yellow": None}).count() == 4


def test_location_dimension_takes_both_ends(spark):
    rows = [(1, 2, datetime(2024, 2, 1)), (2, 3, datetime(2024, 2, 2))]
    df = spark.createDataFrame(
        rows, "pu_location_id bigint, do_location_id bigint, loaded_at timestamp_ntz"
    )
    got = [tuple(r) for r in M.dim_table(df, M.DIMENSIONS["dim_location"]).collect()]
    assert got == [
        (1, "Location 001", datetime(2024, 2, 1)),
        (2, "Location 002", datetime(2024, 2, 2)),
        (3, "Location 003", datetime(2024, 2, 2)),
    ]


def test_profile_and_preview(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    row = profile(df).first().asDict()
    assert row == {
        "row_count": 3,
        "x_non_null": 2,
        "x_min": 1,
        "x_max": 3,
        "y_non_null": 2,
        "y_min": "a",
        "y_max": "b",
    }
    assert preview(df, 2).count() == 2

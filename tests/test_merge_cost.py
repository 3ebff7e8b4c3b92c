"""What a merge and a first build move: new rows once, old rows not at all."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkelt import schemas as S
from sparkelt.operators.upsert import without_keys
from sparkelt.plans import incremental as I
from sparkelt.plans import models as M
from sparkelt.plans import pipeline as P
from sparkelt.sources import warehouse as W

MODEL = P.STAGING["green"]
T0 = datetime(2024, 2, 1, 8)


def raw(spark, trip_row, ids, hour=0, days=3, **kw):
    rows = []
    for i in ids:
        start = datetime(2024, 1, 1 + i % days, 10)
        times = {"lpep_pickup_datetime": start, "lpep_dropoff_datetime": start + timedelta(minutes=9)}
        rows.append(trip_row(trip_id=f"{i:04x}", loaded_at=T0 + timedelta(hours=hour, seconds=i), **times, **kw))
    return spark.createDataFrame(rows, S.GREEN.raw_schema)


@pytest.fixture
def plans(warehouse, monkeypatch):
    """Plans of what is written."""
    found, write = [], warehouse.write

    def watched(table, df, *more):
        found.append(df._jdf.queryExecution().executedPlan().toString())
        return write(table, df, *more)

    monkeypatch.setattr(warehouse, "write", watched)
    return found


def test_a_build_moves_its_rows_once(spark, warehouse, trip_row, plans):
    I.run_model(warehouse, MODEL, {"raw_green": raw(spark, trip_row, range(60))})
    assert plans[0].count("Exchange") == 1 and warehouse.read(MODEL.table).count() == 60


def test_a_merge_does_not_move_old_rows(spark, warehouse, trip_row, plans, monkeypatch):
    monkeypatch.setattr(I, "TINY_BYTES", 0)
    I.run_model(warehouse, MODEL, {"raw_green": raw(spark, trip_row, range(60))})
    more = raw(spark, trip_row, range(50, 70), hour=1, fare_amount=50.0)
    I.run_model(warehouse, MODEL, {"raw_green": more})
    wide = [line for line in plans[1].splitlines() if "REBALANCE" in line.upper()]
    assert not wide and "fare_amount" not in str([x for x in plans[1].splitlines() if "SortMergeJoin" in x])
    got = {r.trip_id: r.fare_amount for r in warehouse.read(MODEL.table).collect()}
    assert got == {f"{i:04x}": 50.0 if i >= 50 else 10.0 for i in range(70)}
    assert warehouse.read(MODEL.table).count() == 70


@pytest.mark.parametrize("words", [W.BITMAP_WORDS, 0])
def test_without_by_bitmap_and_by_join(spark, warehouse, trip_row, monkeypatch, words):
    monkeypatch.setattr(W, "BITMAP_WORDS", words)
    I.run_model(warehouse, MODEL, {"raw_green": raw(spark, trip_row, range(90))})
    table, whole = MODEL.table, warehouse.read(MODEL.table)
    keys = whole.filter("hash(trip_id) % 3 = 0").select("trip_id", F.to_date("pickup_datetime").alias("pickup_date"))
    got = warehouse.without(table, warehouse.live(table), keys.union(keys))
    want = without_keys(whole, keys, "trip_id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and 0 < want.count() < 90


def test_hot_keys_and_large_partitions_are_settled_alike(spark, trip_row, monkeypatch):
    monkeypatch.setattr(I, "TASK_ROWS", 20)
    monkeypatch.setattr(I, "HOT_ROWS", 30)
    rows = raw(spark, trip_row, range(100), days=2)
    for hour in range(1, 41):
        rows = rows.unionByName(raw(spark, trip_row, [7], hour=hour, days=2, fare_amount=float(hour)))
    rows = M.stg_valid(rows.coalesce(4).localCheckpoint(), S.GREEN)
    odd = rows.filter("trip_id < '0004'").withColumn("trip_id", F.concat(F.lit("No hex "), "trip_id"))
    rows = rows.unionByName(odd)
    found = I._survey(MODEL, rows)
    assert len(found.hot) == 1 and found.rows["2024-01-02"] == 50 + 40 + 2
    got, want = I._settled(MODEL, rows, found), M.stg_newest(rows)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() == 104


def test_units_grow_slower_than_rows(spark, warehouse, trip_row, monkeypatch):
    monkeypatch.setattr(W, "FULL_UNITS", 8)
    warehouse.unit_rows = 1
    I.run_model(warehouse, MODEL, {"raw_green": raw(spark, trip_row, range(72), days=1).coalesce(1)})
    assert 8 < len(warehouse.live(MODEL.table)) <= 8 + 9

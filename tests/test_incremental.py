"""Upsert, watermarks and two-run behaviour."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sparkelt import schemas as S
from sparkelt.fixtures import first_batch, raw_feed
from sparkelt.operators.upsert import merge_into, orphans, upsert
from sparkelt.plans import incremental as I
from sparkelt.plans import pipeline as P
from sparkelt.sources import storage
from sparkelt.sources.warehouse import qualified_name

GREEN_MODEL = P.STAGING["green"]
T0 = datetime(2024, 2, 1, 8)


def green(spark, *rows):
    return spark.createDataFrame(list(rows), S.GREEN.raw_schema)


def run_green(wh, df, **kw):
    return I.run_model(wh, GREEN_MODEL, {"raw_green": df}, **kw)


def staged(wh):
    return {r.trip_id: r.fare_amount for r in wh.read(GREEN_MODEL.table).collect()}


def contents(df):
    return sorted(map(str, df.collect()))


# --- operators --------------------------------------------------------------------------------


def test_upsert_keeps_null_keys_of_both_sides(spark):
    target = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a")], "k int, v string")
    updates = spark.createDataFrame([(2, "b"), (3, "b"), (None, "b")], "k int, v string")
    got = sorted(map(str, (tuple(r) for r in upsert(target, updates, "k").collect())))
    assert got == sorted(map(str, [(1, "a"), (2, "b"), (3, "b"), (None, "a"), (None, "b")]))


def test_orphans_ignore_null_children(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [r[0] for r in orphans(child, "fk", parent, "pk").collect()] == [2, 2]


def test_native_merge_builds_the_whole_upsert(spark, monkeypatch):
    """The command handed to the table format: match on the key, update all, insert all."""
    calls = []

    class Merge:
        def __getattr__(self, name):
            return lambda *a: (calls.append((name, *a)), self)[1]

    def merge_into_table(self, table, condition):
        calls.append(("into", table, str(condition)))
        return Merge()

    monkeypatch.setattr(type(spark.range(1)), "mergeInto", merge_into_table)
    merge_into(spark.range(2), "plain", "id")
    assert calls[0][:2] == ("into", "plain") and "plain.id = fresh.id" in calls[0][2]
    assert [c[0] for c in calls[1:]] == ["whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"]


# --- watermarks -------------------------------------------------------------------------------


def test_first_run_takes_all_then_only_newer_rows(spark, warehouse, trip_row):
    first = run_green(warehouse, green(spark, trip_row(trip_id="a"), trip_row(trip_id="b")))
    assert (first.kind, first.after) == ("full", {"green": T0})
    same_time = trip_row(trip_id="c")
    newer = trip_row(trip_id="a", fare_amount=99.0, loaded_at=T0 + timedelta(seconds=1))
    second = run_green(warehouse, green(spark, same_time, newer))
    assert second.kind == "merge" and second.touched == ["2024-01-05"]
    assert second.after == {"green": T0 + timedelta(seconds=1)}
    assert staged(warehouse) == {"a": 99.0, "b": 10.0}  # equal load time is not newer
    third = run_green(warehouse, green(spark, same_time, newer))
    assert third.kind == "none" and third.after == second.after


def test_an_existing_empty_target_does_not_block_loading(spark, warehouse, trip_row):
    run_green(warehouse, green(spark))
    assert warehouse.exists(GREEN_MODEL.table) and staged(warehouse) == {}
    run_green(warehouse, green(spark, trip_row()))
    assert staged(warehouse) == {"t1": 10.0}


def test_without_marks_a_table_is_built_again(spark, warehouse, trip_row):
    run_green(warehouse, green(spark, trip_row()))
    storage.delete(spark, f"{warehouse.root}/_marks")
    assert I.current_marks(warehouse, GREEN_MODEL) is None
    assert run_green(warehouse, green(spark, trip_row())).after == {"green": T0}


def test_an_interrupted_first_write_is_not_taken_for_a_table(spark, warehouse, trip_row, monkeypatch):
    """Rows are there, but no commit names them."""
    from sparkelt.sources.units import UnitLog

    with monkeypatch.context() as m:
        m.setattr(UnitLog, "commit", lambda *a, **kw: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_green(warehouse, green(spark, trip_row(trip_id="a")))
    assert not warehouse.exists(GREEN_MODEL.table)
    run_green(warehouse, green(spark, trip_row(trip_id="b")))
    assert staged(warehouse) == {"b": 10.0}


def test_full_refresh_forgets_what_the_source_no_longer_has(spark, warehouse, trip_row):
    run_green(warehouse, green(spark, trip_row(trip_id="a")))
    run_green(warehouse, green(spark, trip_row(trip_id="b")), full_refresh=True)
    assert staged(warehouse) == {"b": 10.0}


def test_merge_leaves_other_partitions_alone(spark, warehouse, trip_row):
    other = {
        "lpep_pickup_datetime": datetime(2024, 1, 9, 1),
        "lpep_dropoff_datetime": datetime(2024, 1, 9, 2),
    }
    run_green(warehouse, green(spark, trip_row(trip_id="a"), trip_row(trip_id="b", **other)))
    path = warehouse.path("staging", "stg_green_taxi") + "/pickup_date=2024-01-09"
    before = storage.child_names(spark, path)
    run_green(warehouse, green(spark, trip_row(trip_id="a", loaded_at=T0 + timedelta(hours=1))))
    assert storage.child_names(spark, path) == before
    assert set(staged(warehouse)) == {"a", "b"}


def test_dates_beyond_the_python_calendar_are_merged(spark, warehouse, trip_row):
    """A mistyped year must not stop a run."""

    def far(**kw):
        df = green(spark, trip_row(trip_id="far", **kw))
        stamps = {"lpep_pickup_datetime": "+20240-01-05 10:00:00", "lpep_dropoff_datetime": "+20240-01-05 11:00:00"}
        return df.withColumns({c: F.lit(v).cast("timestamp_ntz") for c, v in stamps.items()})

    run_green(warehouse, green(spark, trip_row()).unionByName(far()))
    later = far(fare_amount=50.0, loaded_at=T0 + timedelta(hours=1))
    assert run_green(warehouse, later).touched == ["+20240-01-05"]
    rows = warehouse.read(GREEN_MODEL.table).select("trip_id", "fare_amount").collect()
    assert {tuple(r) for r in rows} == {("t1", 10.0), ("far", 50.0)}


def test_a_run_that_died_before_its_mark_is_repeated_without_harm(spark, warehouse, trip_row, monkeypatch):
    run_green(warehouse, green(spark, trip_row(trip_id="a")))
    df = green(spark, trip_row(trip_id="b", loaded_at=T0 + timedelta(hours=1)))
    with monkeypatch.context() as m:
        m.setattr(warehouse, "set_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_green(warehouse, df)
    assert I.current_marks(warehouse, GREEN_MODEL) == {"green": T0}
    assert run_green(warehouse, df).kind == "merge"
    assert staged(warehouse) == {"a": 10.0, "b": 10.0}


# --- the whole chain --------------------------------------------------------------------------


def raws(spark, sf_dir):
    return {f.name: raw_feed(spark, sf_dir, f) for f in S.FEEDS.values()}


def test_rerunning_changes_nothing(spark, warehouse, sf_dir):
    raw = raws(spark, sf_dir)
    P.run_models(warehouse, raw)
    before = {n: contents(df) for n, df in P.tables(warehouse).items()}
    again = P.run_models(warehouse, raw)
    assert {r.kind for r in again.values()} == {"none"}
    assert {n: contents(df) for n, df in P.tables(warehouse).items()} == before


def yellow_at(spark, trip_row, hours):
    """A yellow trip loaded so many hours after T0."""
    row = {f.name: None for f in S.YELLOW.raw_schema.fields}
    values = dict(zip(S.GREEN.raw_schema.names, trip_row(), strict=True))
    row |= {k: v for k, v in values.items() if k in row}
    row |= {
        "trip_id": "y1",
        "tpep_pickup_datetime": values["lpep_pickup_datetime"],
        "tpep_dropoff_datetime": values["lpep_dropoff_datetime"],
        "Airport_fee": 0.0,
        "loaded_at": T0 + timedelta(hours=hours),
    }
    return spark.createDataFrame([tuple(row.values())], S.YELLOW.raw_schema)


def test_a_late_feed_is_not_skipped(spark, warehouse, trip_row):
    """Each feed has its own mark: a slow green feed survives a fast yellow one."""
    yellow = yellow_at(spark, trip_row, 5)
    early, late = trip_row(trip_id="g1"), trip_row(trip_id="g2", loaded_at=T0 + timedelta(hours=1))
    P.run_models(warehouse, {"green": green(spark, early), "yellow": yellow})
    P.run_models(warehouse, {"green": green(spark, early, late), "yellow": yellow})
    assert {r.trip_id for r in warehouse.read(P.FACT.table).collect()} == {"y1", "g1", "g2"}


def test_a_slow_feed_survives_lost_marks(spark, warehouse, trip_row):
    """Yellow has got to 13:00; a green trip loaded at 09:00 arrives after the fact's marks are lost."""
    raw = {"green": green(spark, trip_row(trip_id="g1")), "yellow": yellow_at(spark, trip_row, 5)}
    P.run_models(warehouse, raw)
    for model in (P.FACT, *P.DIMS.values()):
        storage.delete(spark, f"{warehouse.root}/_marks/{model.table.full_name}")
    late = trip_row(trip_id="g2", payment_type=2, loaded_at=T0 + timedelta(hours=1))
    P.run_models(warehouse, raw | {"green": green(spark, trip_row(trip_id="g1"), late)})
    assert {r.trip_id for r in warehouse.read(P.FACT.table).collect()} == {"y1", "g1", "g2"}
    assert {r.payment_id for r in warehouse.read(P.DIMS["dim_payment"].table).collect()} == {1, 2}


def test_a_model_run_alone_keeps_the_feeds_apart(spark, warehouse, trip_row):
    raw = {"green": green(spark, trip_row(trip_id="g1")), "yellow": yellow_at(spark, trip_row, 5)}
    P.run_models(warehouse, raw, only=["int_metrics_added"])
    source = {"int_metrics_added": warehouse.read(P.INT_METRICS.table)}
    assert I.run_model(warehouse, P.FACT, source).after == {"green": T0, "yellow": T0 + timedelta(hours=5)}


def test_row_wise_models_follow_without_exchange(spark, warehouse, sf_dir, monkeypatch):
    raw = raws(spark, sf_dir)
    P.run_models(warehouse, {n: first_batch(df) for n, df in raw.items()}, only=["fact_trip"])
    plans = {}
    write = warehouse.write

    def watched(table, df, *more):
        plans[table.name] = df._jdf.queryExecution().executedPlan().toString()
        return write(table, df, *more)

    monkeypatch.setattr(warehouse, "write", watched)
    P.run_models(warehouse, raw, only=["fact_trip"])
    for name in ("int_metrics_added", "fact_trip"):
        assert "Exchange" not in plans[name] and "Join" not in plans[name]


def test_a_trip_that_stops_passing_keeps_its_old_row(spark, warehouse, trip_row):
    yellow = spark.createDataFrame([], S.YELLOW.raw_schema)
    bad = trip_row(fare_amount=-5.0, loaded_at=T0 + timedelta(hours=1))
    for rows in ([trip_row()], [trip_row(), bad]):
        P.run_models(warehouse, {"green": green(spark, *rows), "yellow": yellow})
    assert staged(warehouse) == {"t1": -5.0}
    assert [r.fare_amount for r in warehouse.read(P.FACT.table).collect()] == [10.0]


def test_a_reader_that_fell_behind_sees_every_partition(spark, warehouse, sf_dir, monkeypatch):
    raw = raws(spark, sf_dir)
    P.run_models(warehouse, {n: first_batch(df) for n, df in raw.items()})
    with monkeypatch.context() as m:  # second run dies after staging
        m.setattr(P, "INT_BOTH", None)
        with pytest.raises(AttributeError):
            P.run_models(warehouse, raw)
    results = P.run_models(warehouse, raw)
    assert results["stg_green_taxi"].kind == "none" and results["fact_trip"].kind == "merge"
    if sf_dir == "/root/testdata/sf0.001":
        assert warehouse.read(P.FACT.table).count() == 867 + 1875


def test_dims_whose_marks_have_drifted_catch_up(spark, warehouse, sf_dir):
    raw = raws(spark, sf_dir)
    P.run_models(warehouse, raw)
    want = contents(warehouse.read(P.DIMS["dim_payment"].table))
    storage.delete(spark, warehouse.path("mart", "dim_payment"))
    results = P.run_models(warehouse, raw)
    assert results["dim_payment"].kind == "full" and results["dim_vendor"].kind == "none"
    assert contents(warehouse.read(P.DIMS["dim_payment"].table)) == want


def test_fact_files_are_sorted_newest_first(spark, warehouse, sf_dir):
    P.run_models(warehouse, raws(spark, sf_dir))
    df = warehouse.read(P.FACT.table).withColumns(
        {"f": F.input_file_name(), "i": F.monotonically_increasing_id()}
    )
    files = {}
    for r in sorted(df.select("f", "i", "pickup_datetime").collect(), key=lambda r: r.i):
        files.setdefault(r.f, []).append(r.pickup_datetime)
    assert files and all(t == sorted(t, reverse=True) for t in files.values())


# --- layers and catalog -----------------------------------------------------------------------


def test_layer_names():
    assert qualified_name(" mart ", "fact_trip") == "mart.fact_trip"
    assert qualified_name(None, "green_taxi") == "raw.green_taxi"


def test_register_makes_tables_queryable(spark, warehouse, sf_dir):
    try:
        P.run_models(warehouse, raws(spark, sf_dir))
        for _ in range(2):
            warehouse.register([m.table for m in P.MODELS.values()])
        rows = spark.sql(
            "SELECT d.payment_name, count(*) AS n FROM mart.fact_trip f "
            "JOIN mart.dim_payment d USING (payment_id) GROUP BY d.payment_name"
        ).collect()
        assert sum(r.n for r in rows) == warehouse.read(P.FACT.table).count()
        assert spark.table("raw.green_taxi").isEmpty()
    finally:
        for db in ("raw", "staging", "intermediate", "mart"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")

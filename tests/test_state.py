"""Models kept by streaming queries: newest version per key, dimension members; bitmap of keys."""

from datetime import datetime, timedelta

import pytest

from sparkelt import schemas as S
from sparkelt.fixtures import first_batch, raw_feed, second_batch
from sparkelt.operators.upsert import key_bitmap, orphans, orphans_by_bitmap
from sparkelt.plans import models as M
from sparkelt.plans import pipeline as P
from sparkelt.sources.readers import stream_parquet
from sparkelt.streaming import state
from sparkelt.streaming.ingest import UNTIL_DRAINED

DAY = datetime(2024, 1, 1)


@pytest.fixture
def feed_of(spark, tmp_path):
    """Adds rows to a folder and lets a new query over the folder take them in."""

    def add(rows, start):
        drop = str(tmp_path / "drop")
        rows.coalesce(1).write.mode("append").parquet(drop)
        start(stream_parquet(spark, drop, rows.schema)).awaitTermination()

    return add


def test_newest_within_the_bound(spark, tmp_path, feed_of):
    seen = []
    schema = "k string, at timestamp_ntz, loaded int, v string"

    def start(rows):
        newest = state.newest_per_key(rows, "k", "at", "3 days", ["loaded", "v"])
        writer = newest.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
        return writer.foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect()))).trigger(**UNTIL_DRAINED).start()

    def drop(*rows):
        del seen[:]
        made = [(k, None if day is None else DAY + timedelta(days=day), loaded, v) for k, day, loaded, v in rows]
        feed_of(spark.createDataFrame(made, schema), start)
        return sorted((k, loaded, v) for k, _, loaded, v in seen)

    assert drop(("a", 0, 1, "x"), ("a", 0, 2, "y"), ("b", 0, None, "z"), ("c", None, 1, "?")) == [("a", 2, "y"), ("b", None, "z")]
    # An older version in a later batch does not win; a key without new rows is not emitted.
    assert drop(("a", 0, 1, "w"), ("d", 2, 1, "x")) == [("a", 2, "y"), ("d", 1, "x")]
    assert drop(("a", 0, 3, "x"), ("b", 0, 1, None), ("e", 9, 1, "x")) == [("a", 3, "x"), ("b", 1, None), ("e", 1, "x")]
    # The watermark is at day six now: what was picked up before is settled.
    assert drop(("a", 0, 9, "late"), ("f", 5, 1, "late"), ("e", 9, 2, "x")) == [("e", 2, "x")]


def test_staging_after_a_crash_is_that_of_the_batch_model(spark, sf_dir, warehouse, monkeypatch, feed_of):
    feed, raw = S.GREEN, raw_feed(spark, sf_dir, S.GREEN)
    whole, fail = state.merged, [False, True, False]

    def merged(*args):
        done = whole(*args)
        if fail.pop(0):
            raise RuntimeError("lost after the write")
        return done

    monkeypatch.setattr(state, "merged", merged)

    def start(rows):
        return state.start_staging(rows, feed, warehouse, f"{warehouse.root}/_cp", trigger=UNTIL_DRAINED)

    feed_of(first_batch(raw), start)
    with pytest.raises(Exception, match="lost after the write"):
        feed_of(second_batch(raw), start)
    start(stream_parquet(spark, f"{warehouse.root}/../drop", raw.schema)).awaitTermination()
    got, want = warehouse.read(P.STAGING["green"].table), M.stg_taxi(raw, feed).select(*S.staging_schema(feed).names)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count() and fail == []
    assert warehouse.marks(P.STAGING["green"].table)["green"] == got.agg({"loaded_at": "max"}).first()[0]


def test_dims_change_only_with_their_members(spark, sf_dir, warehouse, feed_of):
    def trips(part):
        green, yellow = (M.stg_taxi(part(raw_feed(spark, sf_dir, f)), f) for f in (S.GREEN, S.YELLOW))
        return M.int_metrics_added(M.int_both_taxi(green, yellow))

    def start(rows):
        return state.start_dims(rows, warehouse, f"{warehouse.root}/_cp", trigger=UNTIL_DRAINED)

    feed_of(trips(first_batch), start)
    units = {n: warehouse.live(m.table) for n, m in P.DIMS.items()}
    again = trips(first_batch).limit(50)
    feed_of(again, start)
    assert {n: warehouse.live(m.table) for n, m in P.DIMS.items()} == units
    one = trips(second_batch).filter("vendor_id = 1").limit(1)
    feed_of(one, start)
    trip = one.first()
    vendor = {r.vendor_id: r.loaded_at for r in warehouse.read(P.DIMS["dim_vendor"].table).collect()}
    assert vendor[1] == trip.loaded_at and vendor[2] < trip.loaded_at
    assert warehouse.marks(P.DIMS["dim_vendor"].table) == {"green": None, "yellow": None}


CHILDREN = [1, 2, None, -5, -6, 40_000, 40_001, 2**40, 2**40 + 1, -(2**62), 2**63 - 1, 0, 2, 2]
PARENTS = [1, -5, 40_000, 2**40, None, 1, -(2**62), 7]


@pytest.mark.parametrize("most_words", [2048, 2])
def test_orphans_by_bitmap(spark, most_words):
    child = spark.createDataFrame([(i, v) for i, v in enumerate(CHILDREN)], "word int, fk long")
    parent = spark.createDataFrame([(v,) for v in PARENTS], "pk long")
    got = orphans_by_bitmap(child, "fk", parent, "pk", most_words)
    assert got.columns == child.columns
    want = sorted((i, v) for i, v in enumerate(CHILDREN) if v is not None and v not in PARENTS)
    same = orphans(child, "fk", parent, "pk").select(*child.columns)
    assert sorted(map(tuple, got.collect())) == want == sorted(map(tuple, same.collect()))
    assert orphans_by_bitmap(child, "fk", parent.limit(0), "pk").count() == len(CHILDREN) - 1
    assert orphans_by_bitmap(child.limit(0), "fk", parent, "pk").count() == 0


def test_bitmap_spares_the_child_a_shuffle(spark, sf_dir):
    child = raw_feed(spark, sf_dir, S.YELLOW)
    parent = child.select("PULocationID").filter("PULocationID < 200")
    plan = orphans_by_bitmap(child, "PULocationID", parent, "PULocationID")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the words of the bitmap
    assert key_bitmap(parent, "PULocationID").count() == 1

"""Raw tables: manifest, compaction, dead letters."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkelt import schemas as S
from sparkelt.fixtures import raw_feed
from sparkelt.functions.wire import extract_payload
from sparkelt.plans import pipeline as P
from sparkelt.plans.incremental import watermark
from sparkelt.queries import spoilt
from sparkelt.sources import batches, storage
from sparkelt.sources.batches import Batch, micros
from sparkelt.sources.readers import stream_parquet
from sparkelt.streaming import sinks
from sparkelt.streaming.ingest import DEAD_LETTER, UNTIL_DRAINED, start_ingest
from sparkelt.streaming.publish import to_messages

FEED = S.GREEN
DAY = datetime(2024, 2, 1)


def contents(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def loaded(spark, warehouse, sf_dir):
    """A raw table of 1,000 batches over two days, one load time each, and its rows."""
    raw = raw_feed(spark, sf_dir, FEED)
    n = F.pmod(F.xxhash64("trip_id"), F.lit(1000))
    stamp = F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(mins=(n * 2).cast("int"))
    raw = raw.withColumns({"loaded_at": stamp, "query_id": F.lit("q"), "batch_id": n.cast("long")})
    raw = raw.withColumn("load_date", F.to_date("loaded_at")).repartition(8, "batch_id")
    raw.write.partitionBy("load_date", "query_id", "batch_id").parquet(warehouse.raw_path(FEED))
    batches.adopt(spark, warehouse.raw_path(FEED))
    return warehouse


def test_ranges_tell_what_is_superseded():
    singles = [Batch(t, t, "q", t) for t in range(1, 8)]
    pack, wider = Batch(2, 4, "pack-a", 0), Batch(1, 5, "pack-b", 0)
    live, gone = batches.split([*singles, pack])
    assert live == [singles[0], pack, *singles[4:]] and gone == singles[1:4]
    live, gone = batches.split([*singles, pack, wider, Batch(1, 5, "pack-c", 0)])
    assert live == [wider, *singles[5:]] and len(gone) == 7
    assert all(Batch.parse(b.entry) == b for b in (*singles, pack))
    assert Batch(micros(datetime(2024, 2, 3, 4)), 0, "q", 7).folder == "load_date=2024-02-03/query_id=q/batch_id=7"


def test_a_thousand_batches_become_few_files(spark, loaded):
    before = loaded.read_raw(FEED)
    rows, mark = contents(before), watermark(before)
    live = batches.live_batches(spark, loaded.raw_path(FEED))
    assert 800 < len(live) <= 1000
    assert loaded.compact_raw(FEED) == 2  # one folder per day
    after = loaded.read_raw(FEED)
    assert len(after.inputFiles()) == 2
    assert contents(after) == rows and watermark(after) == mark
    assert contents(before) == rows  # a reader from before still has its files
    assert loaded.compact_raw(FEED) == 0
    assert loaded.vacuum_raw(FEED) == []
    assert len(loaded.vacuum_raw(FEED, timedelta(0))) == len(live)
    assert contents(loaded.read_raw(FEED)) == rows
    assert len(batches.live_batches(spark, loaded.raw_path(FEED))) == 2


def test_folders_reach_their_target_size_and_stay(spark, loaded):
    path = loaded.raw_path(FEED)
    rows = contents(loaded.read_raw(FEED))
    target = 40 * storage.size_of(spark, f"{path}/{batches.live_batches(spark, path)[0].folder}")
    made = loaded.compact_raw(FEED, target)
    live = batches.live_batches(spark, path)
    assert 20 < made and len(live) < 100
    large = [b for b in live if storage.size_of(spark, f"{path}/{b.folder}") >= target // 2]
    loaded.compact_raw(FEED, target)
    assert set(large) <= set(batches.live_batches(spark, path))
    assert contents(loaded.read_raw(FEED)) == rows


def test_a_compaction_that_dies_changes_nothing(spark, loaded, monkeypatch):
    rows = contents(loaded.read_raw(FEED))
    real = batches.enter
    with monkeypatch.context() as m:
        m.setattr(batches, "enter", lambda s, p, b: real(s, p, b) if b.least == micros(DAY) else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loaded.compact_raw(FEED)
    assert contents(loaded.read_raw(FEED)) == rows  # of two folders, at most one was swapped in
    loaded.compact_raw(FEED)
    assert contents(loaded.read_raw(FEED)) == rows
    loaded.vacuum_raw(FEED, timedelta(0))
    assert contents(loaded.read_raw(FEED)) == rows
    path = loaded.raw_path(FEED)
    folders = [n for d in storage.child_names(spark, path) if d.startswith("load_date=") for n in storage.child_names(spark, f"{path}/{d}") if n.startswith("query_id=pack-")]
    assert len(folders) == len(batches.live_batches(spark, path)) == 2


def test_staging_reads_batches_past_its_mark_only(spark, loaded, trip_row):
    model = P.STAGING["green"]
    P.run_models(loaded, only=[model.name])
    mark = loaded.marks(model.table)["green"]
    path = loaded.raw_path(FEED)
    late = Batch(micros(mark + timedelta(minutes=5)), micros(mark + timedelta(minutes=5)), "q", 5000)
    row = trip_row(trip_id="late", loaded_at=mark + timedelta(minutes=5))
    spark.createDataFrame([row], FEED.raw_schema).coalesce(1).write.parquet(f"{path}/{late.folder}")
    batches.enter(spark, path, late)
    df = loaded.read_raw(FEED, mark)
    assert len(df.inputFiles()) == 1 and late.folder in df.inputFiles()[0]
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in scan and "batch_id=5000" in scan
    assert P.run_models(loaded, only=[model.name])[model.name].kind == "merge"
    assert loaded.read(model.table).filter("trip_id = 'late'").count() == 1


def test_the_last_batch_of_a_query_is_not_packed_and_may_be_replayed(spark, warehouse, trip_row):
    sink = sinks.parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    for n in range(4):
        sink(spark.createDataFrame([trip_row(VendorID=n)], FEED.raw_schema), n)
    assert warehouse.compact_raw(FEED) == 1
    left = batches.live_batches(spark, warehouse.raw_path(FEED))
    assert [b.query_id.startswith("pack-") for b in left] == [True, False]
    sink(spark.createDataFrame([trip_row(VendorID=3)] * 2, FEED.raw_schema), 3)  # replayed, differently
    sink(spark.createDataFrame([trip_row(VendorID=4)], FEED.raw_schema), 4)
    assert sorted(r.VendorID for r in warehouse.read_raw(FEED).collect()) == [0, 1, 2, 3, 3, 4]


def test_a_table_without_a_manifest_is_adopted(spark, warehouse, trip_row):
    path = warehouse.raw_path(FEED)
    old = spark.createDataFrame([trip_row(VendorID=1)], FEED.raw_schema)
    old.withColumns({"load_date": F.lit(date(2024, 2, 1)), "query_id": F.lit("old"), "batch_id": F.lit(0)}).write.partitionBy("load_date", "query_id", "batch_id").parquet(path)
    assert warehouse.read_raw(FEED).count() == 1
    sinks.parquet_batch_sink(FEED, path)(spark.createDataFrame([trip_row(VendorID=2)], FEED.raw_schema), 0)
    assert sorted(r.VendorID for r in warehouse.read_raw(FEED).collect()) == [1, 2]
    assert len(batches.live_batches(spark, path)) == 2


def test_a_batch_without_an_entry_is_not_there(spark, warehouse, trip_row, monkeypatch):
    sink = sinks.parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    sink(spark.createDataFrame([trip_row(VendorID=1)], FEED.raw_schema), 0)
    more = spark.createDataFrame([trip_row(VendorID=2)], FEED.raw_schema)
    with monkeypatch.context() as m:
        m.setattr(batches, "enter", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sink(more, 1)
    assert [r.VendorID for r in warehouse.read_raw(FEED).collect()] == [1]
    sink(more, 1)
    assert sorted(r.VendorID for r in warehouse.read_raw(FEED).collect()) == [1, 2]


# --- dead letters -----------------------------------------------------------------------------


def judged(spark, values, fmt):
    from sparkelt.functions.wire import judge_payload

    df = spark.createDataFrame([(v,) for v in values], "value binary")
    return [(r.value and bytes(r.value), r.reason) for r in judge_payload(df, FEED, fmt).collect()]


def test_reasons(spark, trip_row):
    good = to_messages(spark.createDataFrame([trip_row()], FEED.raw_schema), FEED, "json").first().value
    cases = {
        bytes(good): None,
        b"{}": None,
        b"": "malformed body",
        b"{": "malformed body",
        b"[1]": "malformed body",
        b"soon": "malformed body",
        b'{"VendorID": "x"}': "malformed body",
        b'{"lpep_pickup_datetime": "soon"}': "unreadable time",
        b'{"lpep_dropoff_datetime": "2024-13-01T00:00:00"}': "unreadable time",
        b"\xff\xfe{": "malformed body",
    }
    assert dict(judged(spark, cases, "json")) == cases
    assert judged(spark, [None], "json") == [(None, "no value")]
    framed = {b"\0\0\0\0\x07" + v: r for v, r in cases.items()}
    framed |= {b"\0\0\0": "no frame", b"{}{}{}": "no frame"}
    assert dict(judged(spark, framed, "framed_json")) == framed


def test_dead_letters_are_replaced_on_replay(spark, warehouse, sf_dir, tmp_path, monkeypatch):
    raw = raw_feed(spark, sf_dir, FEED)
    messages = to_messages(raw, FEED, "framed_json", 7, keep=("trip_id",)).transform(spoilt)
    drop, dead = str(tmp_path / "messages"), f"{warehouse.raw_path(FEED)}_dead"
    messages.write.parquet(drop)
    sink = sinks.dead_letter_sink(FEED, warehouse.raw_path(FEED), dead)

    def once():
        source = stream_parquet(spark, drop, "value binary")
        start_ingest(source, FEED, sink, str(tmp_path / "cp"), "framed_json", UNTIL_DRAINED, DEAD_LETTER).awaitTermination()

    with monkeypatch.context() as m:  # dies when both tables are written, before the batch counts
        m.setattr(batches, "enter", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division"):
            once()
    letters = sinks.read_dead_letters(spark, dead)
    assert letters.count() > 0 and warehouse.read_raw(FEED).count() == 0
    once()
    kind = F.substring("trip_id", 1, 1)
    bad = raw.filter(kind.isin("0", "1", "2", "3")).count()
    letters = sinks.read_dead_letters(spark, dead)
    assert letters.count() == bad and warehouse.read_raw(FEED).count() == raw.count() - bad
    assert {r.reason for r in letters.select("reason").distinct().collect()} == {"no value", "no frame", "malformed body", "unreadable time"}
    assert letters.select("loaded_at").distinct().collect() == warehouse.read_raw(FEED).select("loaded_at").distinct().collect()


def test_dead_letters_need_their_sink(spark, warehouse, tmp_path):
    plain = sinks.parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    for sink, mode in ((plain, DEAD_LETTER), (sinks.dead_letter_sink(FEED, "a", "b"), "FAILFAST")):
        with pytest.raises(ValueError, match="go together"):
            start_ingest(spark.range(1), FEED, sink, str(tmp_path / "cp"), "json", UNTIL_DRAINED, mode)


def test_no_letters_no_table(spark, warehouse):
    assert sinks.read_dead_letters(spark, f"{warehouse.root}/none").collect() == []


def test_malformed_bodies_fail_by_default(spark):
    df = spark.createDataFrame([(bytearray(b"{"),)], "value binary")
    with pytest.raises(Exception, match="(?i)malformed"):
        extract_payload(df, FEED, "json").collect()
    assert extract_payload(df, FEED, "json", mode="PERMISSIVE").first().VendorID is None

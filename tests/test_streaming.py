"""The ingest job on bounded streams."""

import json
import logging
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sparkelt import schemas as S
from sparkelt.fixtures import first_batch, raw_feed, second_batch
from sparkelt.plans import pipeline as P
from sparkelt.sources.readers import read_kafka_stream, read_parquet, stream_parquet
from sparkelt.streaming.ingest import UNTIL_DRAINED, decoded_stream, start_ingest
from sparkelt.streaming.publish import to_messages, write_kafka
from sparkelt.streaming.sinks import jdbc_batch_sink, parquet_batch_sink, start_file_sink

FEED = S.GREEN


@pytest.fixture
def drop(spark, tmp_path):
    """A folder of message files, and a stream over it."""

    class Drop:
        path = str(tmp_path / "messages")

        def add(self, df, fmt="json"):
            to_messages(df, FEED, fmt).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self, files=None):
            return stream_parquet(spark, self.path, "value binary", files)

    return Drop()


def ingest(drop, sink, tmp_path, fmt="json", files=None):
    query = start_ingest(drop.stream(files), FEED, sink, str(tmp_path / "cp"), fmt, UNTIL_DRAINED)
    query.awaitTermination()


def test_ingest_then_models(spark, warehouse, drop, tmp_path, sf_dir):
    """Two drops with a model run after each; raw load times drive the incremental reads."""
    raw = raw_feed(spark, sf_dir, FEED)
    sink = parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    counts = []
    for batch in (first_batch(raw), second_batch(raw)):
        drop.add(batch, "framed_json")
        ingest(drop, sink, tmp_path, "framed_json")
        results = P.run_models(warehouse)
        counts.append(warehouse.read(P.STAGING["green"].table).count())
    assert warehouse.read_raw(FEED).count() == raw.count()
    assert results["stg_green_taxi"].kind == "merge" and results["stg_yellow_taxi"].kind != "merge"
    assert counts[1] == raw_staged(raw)
    assert warehouse.source("green_taxi").columns == FEED.raw_schema.names


def raw_staged(raw):
    from sparkelt.operators.filters import drop_invalid

    return drop_invalid(raw, FEED).select("trip_id").distinct().count()


def test_a_new_checkpoint_adds_to_the_same_day(spark, warehouse, drop, tmp_path, trip_row):
    """Batch numbers start at zero again; the rows of the first checkpoint stay."""
    sink = parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    for n in (1, 2):
        drop.add(spark.createDataFrame([trip_row(VendorID=n)], FEED.raw_schema))
        query = start_ingest(drop.stream(), FEED, sink, str(tmp_path / f"cp{n}"), "json", UNTIL_DRAINED)
        query.awaitTermination()
    found = [r.VendorID for r in warehouse.read_raw(FEED).collect()]
    assert sorted(found) == [1, 1, 2]  # the second query read both files


def test_load_times_are_utc_and_grow_when_clocks_go_back(spark, warehouse, trip_row, monkeypatch):
    from datetime import datetime, timedelta, timezone

    from sparkelt.sources import storage
    from sparkelt.streaming import sinks

    sink = parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    rows = spark.createDataFrame([trip_row()], FEED.raw_schema)
    real = datetime.now(timezone.utc).replace(tzinfo=None)

    class Slow(datetime):
        @classmethod
        def now(cls, tz=None):
            return datetime.now(tz) - timedelta(hours=1)

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sink(rows, 0)
        monkeypatch.setattr(sinks, "datetime", Slow)
        sink(rows.withColumn("VendorID", F.lit(2).cast("long")), 1)
        sink(rows.withColumn("VendorID", F.lit(2).cast("long")), 1)  # a replay keeps its time
        first, second = (
            warehouse.read_raw(FEED).filter(F.col("VendorID") == v).select("loaded_at").collect() for v in (1, 2)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(first) == len(second) == 1
    assert abs(first[0][0] - real) < timedelta(minutes=5) and second[0][0] > first[0][0]
    assert len([n for n in storage.child_names(spark, warehouse.raw_path(FEED) + "/_loads") if "@" in n and not n.startswith(".")]) == 1


def test_one_load_time_per_batch_and_growing(spark, warehouse, drop, tmp_path, trip_row):
    rows = [spark.createDataFrame([trip_row(VendorID=v)] * 3, FEED.raw_schema) for v in (1, 2)]
    sink = parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    for df in rows:
        drop.add(df)
        ingest(drop, sink, tmp_path)
    times = warehouse.read_raw(FEED).groupBy("VendorID").agg(F.collect_set("loaded_at")).collect()
    by_vendor = dict(tuple(r) for r in times)
    assert [len(t) for t in by_vendor.values()] == [1, 1]
    assert by_vendor[1][0] < by_vendor[2][0]


def test_replayed_batch_replaces_its_first_attempt(spark, warehouse, drop, tmp_path, trip_row):
    drop.add(spark.createDataFrame([trip_row()], FEED.raw_schema))
    good = parquet_batch_sink(FEED, warehouse.raw_path(FEED))

    def dies_after_writing(batch, batch_id):
        good(batch, batch_id)
        raise RuntimeError("lost driver")

    with pytest.raises(Exception, match="lost driver"):
        ingest(drop, dies_after_writing, tmp_path)
    assert warehouse.read_raw(FEED).count() == 1
    first = warehouse.read_raw(FEED).first().loaded_at
    ingest(drop, good, tmp_path)
    assert [r.loaded_at for r in warehouse.read_raw(FEED).collect()] == [first]


def test_a_failing_sink_loses_nothing(spark, warehouse, drop, tmp_path, trip_row):
    drop.add(spark.createDataFrame([trip_row()], FEED.raw_schema))

    def broken(batch, batch_id):
        raise OSError("database away")

    with pytest.raises(Exception, match="database away"):
        ingest(drop, broken, tmp_path)
    ingest(drop, parquet_batch_sink(FEED, warehouse.raw_path(FEED)), tmp_path)
    assert warehouse.read_raw(FEED).count() == 1


def test_restart_continues_from_the_checkpoint(spark, warehouse, drop, tmp_path, trip_row):
    sink = parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    for v in (1, 2, 3):
        drop.add(spark.createDataFrame([trip_row(VendorID=v)], FEED.raw_schema))
        ingest(drop, sink, tmp_path, files=1)
    got = sorted(r.VendorID for r in warehouse.read_raw(FEED).collect())
    assert got == [1, 2, 3]


def test_sink_logs_counts_and_skips_empty_batches(spark, warehouse, trip_row, caplog):
    sink = parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    df = spark.createDataFrame([trip_row()] * 2, FEED.raw_schema)
    with caplog.at_level(logging.INFO, "sparkelt.streaming.sinks"):
        sink(df, 0)
        sink(df.filter("false"), 1)
    assert "batch 0: 2 rows" in caplog.text and "batch 1 is empty" in caplog.text
    assert warehouse.read_raw(FEED).count() == 2
    days = os.listdir(warehouse.raw_path(FEED))
    assert not any("batch_id=1" in str(b) for d in days if "=" in d for b in os.listdir(f"{warehouse.raw_path(FEED)}/{d}"))


def test_raw_reads_only_load_dates_that_can_be_newer(spark, warehouse, trip_row, monkeypatch):
    from datetime import datetime

    from sparkelt.streaming import sinks

    monkeypatch.setattr(sinks, "_stamp_of", lambda spark, folder, query, batch: datetime(2024, 2, batch, 5))
    sink = parquet_batch_sink(FEED, warehouse.raw_path(FEED))
    for day in (1, 2, 3):
        sink(spark.createDataFrame([trip_row()], FEED.raw_schema), day)
    df = warehouse.read_raw(FEED, datetime(2024, 2, 2, 4))
    assert sorted(r.loaded_at.day for r in df.collect()) == [2, 3]
    assert len(df.inputFiles()) == 2


def test_jdbc_sink_appends_in_table_order(spark, trip_row, monkeypatch):
    """The database itself is left out: what would be sent to it is recorded."""
    calls = []

    def record(self, url, table, mode=None, properties=None):
        calls.append((url, table, mode, properties, self._df.columns, self._df.count()))
        self._df.write.format("noop").mode("append").save()

    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    sink = jdbc_batch_sink(FEED, "jdbc:x://h/db", "raw.green_taxi", {"user": "u"})
    sink(spark.createDataFrame([trip_row()], FEED.raw_schema).select(*reversed(FEED.raw_schema.names)), 4)
    assert calls == [
        ("jdbc:x://h/db", "raw.green_taxi", "append", {"user": "u"}, FEED.load_schema.names, 1)
    ]


def test_json_file_sink(spark, drop, tmp_path, trip_row):
    drop.add(spark.createDataFrame([trip_row()] * 5, FEED.raw_schema).repartition(4))
    out = str(tmp_path / "json")
    rows = decoded_stream(drop.stream(), FEED, "json").drop("loaded_at")
    query = start_file_sink(rows, out, str(tmp_path / "cp"), files_per_batch=1, trigger=UNTIL_DRAINED)
    query.awaitTermination()
    files = [f for f in os.listdir(out) if f.endswith(".json")]
    assert len(files) == 1
    with open(f"{out}/{files[0]}") as f:
        lines = [json.loads(line) for line in f]
    assert len(lines) == 5 and lines[0]["VendorID"] == 1


def test_both_feeds_run_side_by_side(spark, warehouse, sf_dir, tmp_path):
    queries = []
    for feed in S.FEEDS.values():
        folder = str(tmp_path / feed.name)
        to_messages(raw_feed(spark, sf_dir, feed), feed, "framed_json").write.parquet(folder)
        source = stream_parquet(spark, folder, "value binary")
        sink = parquet_batch_sink(feed, warehouse.raw_path(feed))
        queries.append(start_ingest(source, feed, sink, str(tmp_path / f"cp_{feed.name}"), "framed_json", trigger=UNTIL_DRAINED))
    for q in queries:
        q.awaitTermination()
    for feed in S.FEEDS.values():
        assert warehouse.read_raw(feed).count() == raw_feed(spark, sf_dir, feed).count()


def test_kafka_is_a_plain_spark_source_and_sink(spark):
    """Without the Kafka module Spark names it; with it, these calls reach a broker."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_kafka_stream(spark, "h:9092", FEED.topic, max_offsets_per_trigger=10, min_partitions=4)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        write_kafka(spark.createDataFrame([(bytearray(b"x"),)], "value binary"), "h:9092", FEED.topic)


def test_parquet_scan(spark, sf_dir):
    assert read_parquet(spark, f"{sf_dir}/lineitem.parquet").count() > 0

"""Micro-batch sinks for ``foreachBatch`` and the file-stream sink.

A sink function raises when it cannot write. The streaming query then fails with the batch
uncommitted and replays it after a restart, so no batch is lost to an error.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkelt.schemas import FeedSpec
from sparkelt.sources import batches, storage
from sparkelt.sources.batches import EPOCH, RAW_FORMAT, Batch, micros

log = logging.getLogger(__name__)

BatchSink = Callable[[DataFrame, int], None]


def batch_sink(columns: list[str], write: Callable[[DataFrame, int], Callable[[], None] | None]) -> BatchSink:
    """Fix the column order, write once, log the row count.

    The batch is decoded once: its count is observed during the write, and emptiness is read off the
    count, since a write without rows leaves nothing behind. What ``write`` returns is called once
    rows have been written.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        done = write(batch.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows")), batch_id)
        rows = seen.get["rows"]
        if rows == 0:
            log.info("batch %s is empty, nothing written", batch_id)
            return
        if done is not None:
            done()
        log.info("batch %s: %s rows written", batch_id, rows)

    return load


def _stamp_of(spark: SparkSession, folder: str, query_id: str, batch_id: int) -> datetime:
    """The load time of a batch: now in UTC, but later than any other batch's in ``folder``.

    It is noted before the batch is written, so a replay finds it. Notes of a query's earlier
    batches are removed; those of the last one stay, to be outlived.
    """
    own = f"{query_id}.{batch_id:012d}"
    notes = [n.split("@") for n in storage.child_names(spark, folder) if "@" in n and not n.endswith(".tmp")]
    for name, stamp in notes:
        if name == own:
            return EPOCH + timedelta(microseconds=int(stamp))
    now = (datetime.now(timezone.utc).replace(tzinfo=None) - EPOCH) // timedelta(microseconds=1)
    stamp = max([now, *[int(s) + 1 for _, s in notes]])
    storage.write_text(spark, f"{folder}/{own}@{stamp:020d}", "")
    for name, old in notes:
        if name.startswith(f"{query_id}.") and name < own:
            storage.delete(spark, f"{folder}/{name}@{old}")
    return EPOCH + timedelta(microseconds=stamp)


def _put(rows: DataFrame, path: str, stamp: datetime, query_id: str, batch_id: int) -> None:
    """Rows of a batch into its own folder, in place of what a first attempt left there."""
    placed = rows.withColumns(
        {
            "loaded_at": F.lit(stamp.isoformat()).cast("timestamp_ntz"),
            "load_date": F.lit(stamp.date()),
            "query_id": F.lit(query_id),
            "batch_id": F.lit(batch_id).cast("long"),
        }
    )
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**RAW_FORMAT)
    writer.partitionBy("load_date", "query_id", "batch_id").parquet(path)


def _query_id(spark: SparkSession) -> str:
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def parquet_batch_sink(feed: FeedSpec, path: str) -> BatchSink:
    """Raw table folder, one ``load_date=/query_id=/batch_id=`` partition per batch.

    The query's id belongs to its checkpoint: a query with a new checkpoint counts its batches from
    zero again and must not replace those of the old one. A replayed batch gets the load time of its
    first attempt and replaces it. Load times of a feed grow from batch to batch, also when clocks
    go back, as later reads rely on it. A batch is part of the table once the manifest names it.
    """

    def write(batch: DataFrame, batch_id: int) -> Callable[[], None]:
        spark = batch.sparkSession
        query_id = _query_id(spark)
        if not batches.has_manifest(spark, path):
            batches.adopt(spark, path)
        stamp = _stamp_of(spark, f"{path}/_loads", query_id, batch_id)
        _put(batch, path, stamp, query_id, batch_id)
        return lambda: batches.enter(spark, path, Batch(micros(stamp), micros(stamp), query_id, batch_id))

    return batch_sink(feed.raw_schema.names, write)


def dead_letter_sink(feed: FeedSpec, path: str, dead_path: str) -> BatchSink:
    """Good rows to the raw table, malformed messages with their bytes and a reason to another one.

    Takes batches of ``judged_stream``. A batch is decoded once, into files beside the dead letters that stay
    until both tables have it, so that it takes no executor's memory; the bytes of good messages are not kept.
    The dead letters go first: once the raw table has a batch, its dead letters are there. A replay
    replaces both parts.
    """
    good = parquet_batch_sink(feed, path)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = _query_id(spark)
        judged = batch.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
        aside = f"{dead_path}/_judged/{query_id}.{batch_id:012d}"
        try:
            judged.write.mode("overwrite").options(**RAW_FORMAT).parquet(aside)
            batch = spark.read.schema(judged.schema).parquet(aside)
            stamp = _stamp_of(spark, f"{path}/_loads", query_id, batch_id)
            seen = Observation()
            bad = batch.filter("reason IS NOT NULL").select("value", "reason")
            _put(bad.observe(seen, F.count(F.lit(1)).alias("rows")), dead_path, stamp, query_id, batch_id)
            if seen.get["rows"]:
                log.warning("batch %s: %s dead letters", batch_id, seen.get["rows"])
            good(batch.filter("reason IS NULL"), batch_id)
        finally:
            storage.delete(spark, aside)

    load.sets_aside = True
    return load


def read_dead_letters(spark: SparkSession, dead_path: str) -> DataFrame:
    """value, reason, loaded_at, load_date, query_id, batch_id of all dead letters."""
    schema = "value binary, reason string, loaded_at timestamp_ntz, load_date date, query_id string, batch_id long"
    if not any(n.startswith("load_date=") for n in storage.child_names(spark, dead_path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(dead_path)


def jdbc_batch_sink(
    feed: FeedSpec, url: str, table: str, properties: Mapping[str, str]
) -> BatchSink:
    """Append to a database table, ``loaded_at`` left to the table's default.

    At least once: a replayed batch is appended again and staging keeps one version per trip.
    Connections per batch are bounded by the ``numPartitions`` property.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(url=url, table=table, mode="append", properties=dict(properties))

    return batch_sink(feed.load_schema.names, write)


def start_file_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    files_per_batch: int | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Append the stream to files, exactly once.

    ``files_per_batch`` merges a batch into that many files. It limits the batch's parallelism to
    the same number, so leave it unset for large batches.
    """
    if files_per_batch is not None:
        stream = stream.coalesce(files_per_batch)
    writer = stream.writeStream.format(fmt).option("path", path).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()

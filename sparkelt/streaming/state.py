"""Models as streaming queries with keyed state: newest version per key, dimension members.

Both are streaming aggregations in update mode: a batch emits the keys that it touched, with their
value over all batches, and a sink merges them into the stored table. The merge is keyed, so a
replayed batch does no harm.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkelt.functions.columns import packed_key, unpacked_key
from sparkelt.plans import models as M
from sparkelt.plans import pipeline as P
from sparkelt.plans.incremental import Model, RunResult, apply_updates
from sparkelt.schemas import FeedSpec
from sparkelt.sources import storage
from sparkelt.sources.batches import RAW_FORMAT
from sparkelt.sources.warehouse import MarkDict, Warehouse
from sparkelt.streaming.ingest import EVERY_5_SECONDS
from sparkelt.streaming.sinks import BatchSink

#: A version counts if its trip was picked up at most so long before the latest pickup seen.
LATE_BY = "31 days"
#: State lies on the executors' disks and takes so many MB of memory in each at most; kept in memory, as Spark
#: does by default, it would take as much as there are keys. A query that was begun otherwise goes on as it was.
STATE_MB = 512
STATE_STORE = {
    f"spark.sql.streaming.stateStore.{name}": value
    for name, value in {
        "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "rocksdb.boundedMemoryUsage": "true",
        "rocksdb.maxMemoryUsageMB": str(STATE_MB),
        "rocksdb.trackTotalNumberOfRows": "false",
    }.items()
}
DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
}
_starting = threading.Lock()


def newest_per_key(
    stream: DataFrame, key: str, event_time: str, delay: str, order_by: Sequence[Column | str]
) -> DataFrame:
    """The newest row of each key so far, emitted whenever a batch holds the key.

    ``event_time`` must be a function of the key. State lasts until the watermark, the greatest
    event time less ``delay``, has passed a key's own: it holds the keys of that stretch of
    time only. Rows that come later than that are dropped, as are rows whose event time is NULL.
    Newest is by ``order_by``, NULLs last. Map tasks send one row per key and batch.
    """
    row, order = F.struct(*[c for c in stream.columns if c != key]), F.struct(*order_by)
    timed = stream.filter(F.col(event_time).isNotNull()).withColumn("_event", F.col(event_time).cast("timestamp"))
    by, whole = {"_key": F.col(key)}, F.col("_key")
    if isinstance(stream.schema[key].dataType, T.StringType):  # state has each key once, and hex as bytes
        by = dict(zip(("_key_bytes", "_key_text"), packed_key(key)))
        whole = unpacked_key(*by)
    by_key = timed.withColumns(by).withWatermark("_event", delay).groupBy("_event", *by)
    newest = by_key.agg(F.max_by(row, order).alias("_row")).select(whole.alias(key), "_row.*")
    return newest.select(*stream.columns)


def merged(wh: Warehouse, model: Model, rows: DataFrame, marks: MarkDict | None = None) -> RunResult:
    """Rows as the model's ``build`` makes them into its table: its first rows, or merged by key.

    ``marks`` are stored if given, else those of the rows.
    """
    before = None
    if wh.exists(model.table):
        before = dict.fromkeys(model.feeds) | (wh.marks(model.table) or {})
    return apply_updates(wh, model, rows, before, marks)


def _kept(wh: Warehouse, write: Callable[[Warehouse, DataFrame], None]) -> BatchSink:
    """A sink that may read its batch several times, from files; the state is advanced once.

    A streaming query has a session of its own, in which the stored tables have to be read too.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark, aside = batch.sparkSession, f"{wh.root}/_aside/{uuid.uuid4().hex}"
        try:
            batch.write.options(**RAW_FORMAT).parquet(aside)
            rows = spark.read.schema(batch.schema).parquet(aside)
            if not rows.isEmpty():
                write(wh.within(spark), rows)
        finally:
            storage.delete(spark, aside)

    return load


@contextmanager
def _with(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts; those that the session has made go first."""
    with _starting:
        own = {k: v for k, v in settings.items() if spark.conf.get(k, None) in (None, DEFAULTS.get(k))}
        before = {k: spark.conf.get(k, None) for k in own}
        for k, v in own.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _started(rows: DataFrame, sink: BatchSink, checkpoint: str, trigger: Mapping | None) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _with(rows.sparkSession, STATE_STORE):
        return writer.outputMode("update").trigger(**(trigger or EVERY_5_SECONDS)).start()


# --- staging ----------------------------------------------------------------------------------


def start_staging(
    raw: DataFrame,
    feed: FeedSpec,
    wh: Warehouse,
    checkpoint: str,
    delay: str = LATE_BY,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Keep a feed's staging table up to date from a stream of its raw rows.

    Gives the rows of the batch model as long as no version is later than ``delay``; a later one
    is dropped and the version before it stays.
    """
    model = P.STAGING[feed.name]
    order = ["loaded_at", *M.TIEBREAK]
    rows = newest_per_key(M.stg_valid(raw, feed), "trip_id", "pickup_datetime", delay, order)
    return _started(rows, _kept(wh, lambda own, batch: merged(own, model, batch)), checkpoint, trigger)


# --- dimensions -------------------------------------------------------------------------------


def changed_members(members: DataFrame, stored: DataFrame | None, dim: M.Dimension) -> DataFrame:
    """A dimension's rows out of a batch of members, without those that are stored as they are."""
    rows = M.dim_from_members(members, dim)
    if stored is None:
        return rows
    old = stored.select(F.col(dim.key).alias("_key"), F.col("loaded_at").alias("_loaded"))
    same = F.col(dim.key).eqNullSafe(F.col("_key")) & F.col("loaded_at").eqNullSafe(F.col("_loaded"))
    return rows.join(old, same, "left_anti")


def start_dims(
    metrics: DataFrame,
    wh: Warehouse,
    checkpoint: str,
    dims: Iterable[str] = tuple(M.DIMENSIONS),
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Keep the dimensions up to date from a stream of trips with their metrics.

    State holds the latest load time of each member, as many rows as the dimensions have. Members
    are combined on the map side, so a member that a third of all trips share is no hot spot. A
    batch rewrites the dimensions of which a member is new or was loaded again, and no others.
    Members do not tell the feeds apart, so no marks are stored: a batch run builds the table anew.
    """
    wanted = [M.DIMENSIONS[name] for name in dims]

    def write(own: Warehouse, members: DataFrame) -> None:
        for dim in wanted:
            model = P.DIMS[dim.name]
            stored = own.read(model.table) if own.exists(model.table) else None
            merged(own, model, changed_members(members, stored, dim), dict.fromkeys(model.feeds))

    return _started(M.dim_members(metrics, wanted), _kept(wh, write), checkpoint, trigger)

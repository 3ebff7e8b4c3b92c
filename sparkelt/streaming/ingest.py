"""The ingest job: message stream -> decoded, keyed, stamped rows -> raw table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkelt.functions.wire import extract_payload, judge_payload
from sparkelt.schemas import FeedSpec
from sparkelt.streaming.sinks import BatchSink

EVERY_5_SECONDS = {"processingTime": "5 seconds"}
UNTIL_DRAINED = {"availableNow": True}
DEAD_LETTER = "DEAD_LETTER"


#: The current moment in UTC, whatever the session's zone; in a stream, the batch's logged timestamp.
UTC_NOW = """TIMESTAMP_NTZ'1970-01-01 00:00:00'
    + make_dt_interval(0, 0, 0, CAST(unix_micros(current_timestamp()) AS DECIMAL(18, 0)) / 1000000)"""


def decoded_stream(source: DataFrame, feed: FeedSpec, fmt: str = "avro", mode: str = "FAILFAST") -> DataFrame:
    """Messages as raw-table rows.

    ``loaded_at`` is one UTC value per batch, the same again if the batch is replayed. A sink that
    keeps raw rows raises it where a clock went back.
    """
    rows = extract_payload(source, feed, fmt, mode=mode).withColumn("loaded_at", F.expr(UTC_NOW))
    return rows.select(*feed.raw_schema.names)


def judged_stream(source: DataFrame, feed: FeedSpec, fmt: str = "avro") -> DataFrame:
    """As ``decoded_stream``, with ``value``, the message, and ``reason``, what is wrong with it, if anything."""
    rows = judge_payload(source, feed, fmt).withColumn("loaded_at", F.expr(UTC_NOW))
    return rows.select(*feed.raw_schema.names, "value", "reason")


def start_ingest(
    source: DataFrame,
    feed: FeedSpec,
    sink: BatchSink,
    checkpoint: str,
    fmt: str = "avro",
    trigger: Mapping | None = None,
    mode: str = "FAILFAST",
) -> StreamingQuery:
    """Start one feed's query. Feeds run as independent queries, each with its own checkpoint.

    A malformed message fails the query (mode FAILFAST), becomes a row of NULLs (PERMISSIVE), or is
    set aside (DEAD_LETTER, which takes a ``dead_letter_sink``).
    """
    if (mode == DEAD_LETTER) != getattr(sink, "sets_aside", False):
        raise ValueError("DEAD_LETTER and a dead_letter_sink go together")
    rows = judged_stream(source, feed, fmt) if mode == DEAD_LETTER else decoded_stream(source, feed, fmt, mode)
    writer = rows.writeStream.foreachBatch(sink)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**(trigger or EVERY_5_SECONDS)).start()

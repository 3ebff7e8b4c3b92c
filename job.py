"""Command line of the pipeline, for spark-submit.

    spark-submit job.py publish --feed green --source trips.parquet --bootstrap broker:9092
    spark-submit job.py ingest  --feed green --bootstrap broker:9092 --warehouse s3a://b/wh
    spark-submit job.py models  --warehouse s3a://b/wh
    spark-submit job.py checks  --warehouse s3a://b/wh
    spark-submit job.py compact --warehouse s3a://b/wh
    spark-submit job.py profile --source trips.parquet

``--messages DIR`` takes the place of a broker: publish writes message files there, ingest reads them.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from sparkelt.functions.wire import extract_payload  # noqa: E402
from sparkelt.operators.profile import preview, profile  # noqa: E402
from sparkelt.operators.quality import run_checks  # noqa: E402
from sparkelt.plans import pipeline  # noqa: E402
from sparkelt.schemas import FEEDS  # noqa: E402
from sparkelt.sources.batches import TARGET_BYTES  # noqa: E402
from sparkelt.sources.readers import read_kafka_stream, read_parquet, stream_parquet  # noqa: E402
from sparkelt.sources.warehouse import Warehouse  # noqa: E402
from sparkelt.streaming.ingest import DEAD_LETTER, UNTIL_DRAINED, start_ingest  # noqa: E402
from sparkelt.streaming.publish import event_ordered, to_messages, write_kafka  # noqa: E402
from sparkelt.streaming.sinks import dead_letter_sink, jdbc_batch_sink, parquet_batch_sink, start_file_sink  # noqa: E402


def publish(spark: SparkSession, a: argparse.Namespace) -> int:
    feed = FEEDS[a.feed]
    ordered = event_ordered(read_parquet(spark, a.source), feed)
    messages = to_messages(ordered, feed, a.format, a.schema_id)
    if a.messages:
        messages.write.mode("append").parquet(a.messages)
    else:
        write_kafka(messages, a.bootstrap, a.topic or feed.topic)
    return 0


def ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    feed = FEEDS[a.feed]
    if a.messages:
        source = stream_parquet(spark, a.messages, "value binary", a.max_files)
    else:
        source = read_kafka_stream(
            spark,
            a.bootstrap,
            a.topic or feed.topic,
            max_offsets_per_trigger=a.max_offsets,
            min_partitions=a.min_partitions,
        )
    wh = Warehouse(spark, a.warehouse)
    checkpoint = a.checkpoint or f"{wh.root}/_checkpoints/{feed.name}"
    trigger = UNTIL_DRAINED if a.once else {"processingTime": a.interval}
    if a.mode == DEAD_LETTER and (a.json_path or a.jdbc_url):
        raise SystemExit("dead letters are kept beside the raw folder only")
    if a.json_path:
        rows = extract_payload(source, feed, a.format, parse_times=False, with_key=False, mode=a.mode)
        start_file_sink(rows, a.json_path, checkpoint, trigger=trigger).awaitTermination()
        return 0
    if a.jdbc_url:
        properties = dict(p.split("=", 1) for p in a.jdbc_property)
        sink = jdbc_batch_sink(feed, a.jdbc_url, a.jdbc_table or f"raw.{feed.raw_name}", properties)
    elif a.mode == DEAD_LETTER:
        sink = dead_letter_sink(feed, wh.raw_path(feed), wh.dead_letter_path(feed))
    else:
        sink = parquet_batch_sink(feed, wh.raw_path(feed))
    start_ingest(source, feed, sink, checkpoint, a.format, trigger, a.mode).awaitTermination()
    return 0


def models(spark: SparkSession, a: argparse.Namespace) -> int:
    wh = Warehouse(spark, a.warehouse)
    for name, result in pipeline.run_models(wh, full_refresh=a.full_refresh).items():
        rewritten = "all" if result.touched is None else len(result.touched)
        print(f"{name}: {result.kind}, partitions written: {rewritten}")
    if a.register:
        wh.register([m.table for m in pipeline.MODELS.values()])
    return 0


def compact(spark: SparkSession, a: argparse.Namespace) -> int:
    """Raw batches into large files; then away with folders that nothing reads any more."""
    wh, keep = Warehouse(spark, a.warehouse), timedelta(hours=a.keep_hours)
    for feed in FEEDS.values():
        made = wh.compact_raw(feed, a.target_mb << 20)
        print(f"{feed.raw_name}: folders made: {made}, removed: {len(wh.vacuum_raw(feed, keep))}")
    for name, model in pipeline.MODELS.items():
        print(f"{name}: folders removed: {len(wh.vacuum(model.table, keep))}")
    return 0


def checks(spark: SparkSession, a: argparse.Namespace) -> int:
    wh = Warehouse(spark, a.warehouse)
    found = run_checks(pipeline.tables(wh), pipeline.CHECKS) if a.recount else pipeline.check_report(wh)
    report = found.collect()  # one row per check
    for r in report:
        print(f"{'FAIL' if r.failures else 'ok':4} {r.model} {r.check_name} {r.column_name} {r.failures}")
    return int(any(r.failures for r in report))


def run_all(spark: SparkSession, a: argparse.Namespace) -> int:
    """Models, then checks, as one scheduled job."""
    return models(spark, a) or checks(spark, a)


def show_profile(spark: SparkSession, a: argparse.Namespace) -> int:
    df = read_parquet(spark, a.source)
    df.printSchema()
    preview(df).show()
    profile(df).show(vertical=True, truncate=False)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Trip pipeline jobs")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name, run, *, feed=False, warehouse=False, source=False):
        s = sub.add_parser(name)
        s.set_defaults(run=run)
        if feed:
            s.add_argument("--feed", choices=sorted(FEEDS), required=True)
            s.add_argument("--format", choices=("avro", "framed_json", "json"), default="avro")
            s.add_argument("--topic")
            where = s.add_mutually_exclusive_group(required=True)
            where.add_argument("--bootstrap")
            where.add_argument("--messages")
        if warehouse:
            s.add_argument("--warehouse", required=True)
        if source:
            s.add_argument("--source", required=True)
        return s

    add("publish", publish, feed=True, source=True).add_argument("--schema-id", type=int, default=1)
    s = add("ingest", ingest, feed=True, warehouse=True)
    s.add_argument("--checkpoint")
    s.add_argument("--once", action="store_true", help="stop when everything available is loaded")
    s.add_argument("--interval", default="5 seconds", help="time between micro-batches")
    s.add_argument("--mode", choices=("FAILFAST", "PERMISSIVE", DEAD_LETTER), default="FAILFAST", help="malformed bodies")
    s.add_argument("--max-offsets", type=int, help="messages per micro-batch")
    s.add_argument("--min-partitions", type=int, help="tasks per micro-batch")
    s.add_argument("--max-files", type=int, help="message files per micro-batch")
    s.add_argument("--json-path", help="append decoded messages to JSON files instead")
    s.add_argument("--jdbc-url", help="load into a database table instead of the raw folder")
    s.add_argument("--jdbc-table")
    s.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    for name, job in (("models", models), ("run", run_all)):
        s = add(name, job, warehouse=True)
        s.add_argument("--full-refresh", action="store_true")
        s.add_argument("--register", action="store_true", help="declare the tables in the catalog")
        if name == "run":
            s.add_argument("--recount", action="store_true", help="check all rows, not only new units")
    add("checks", checks, warehouse=True).add_argument("--recount", action="store_true", help="check all rows, not only new units")
    s = add("compact", compact, warehouse=True)
    s.add_argument("--target-mb", type=int, default=TARGET_BYTES >> 20, help="size of compacted raw files")
    s.add_argument("--keep-hours", type=float, default=24, help="how long replaced folders stay for readers")
    add("profile", show_profile, source=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"sparkelt-{args.command}").getOrCreate()
    return args.run(spark, args)


if __name__ == "__main__":
    sys.exit(main())

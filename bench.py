"""Headline timings; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query result is computed in full (all rows, all columns) into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from sparkelt import queries as registry  # noqa: E402
from sparkelt import schemas as S  # noqa: E402
from sparkelt.fixtures import first_batch, raw_feed, second_batch  # noqa: E402
from sparkelt.operators.quality import run_checks  # noqa: E402
from sparkelt.plans import pipeline as P  # noqa: E402
from sparkelt.sources.readers import stream_parquet  # noqa: E402
from sparkelt.sources.storage import scratch_dir  # noqa: E402
from sparkelt.sources.warehouse import Warehouse  # noqa: E402
from sparkelt.streaming.ingest import UNTIL_DRAINED, start_ingest  # noqa: E402
from sparkelt.streaming.publish import to_messages  # noqa: E402
from sparkelt.streaming.sinks import parquet_batch_sink  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "trip_id_key",
    "stg_green_taxi",
    "stg_yellow_taxi",
    "int_both_taxi",
    "int_metrics_added",
    "fact_trip",
    "dim_vendor",
    "dim_location",
    "inc_merge_upsert",
    "dq_not_null",
    "dq_unique",
    "dq_relationships",
    "normalize_payload",
    "decode_json",
    "stream_ingest_green",
    "stream_ingest_yellow",
)


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def ingest(spark, wh: Warehouse) -> None:
    """What is new in both feeds' message folders, as two queries side by side, until drained."""
    running = []
    for feed in S.FEEDS.values():
        source = stream_parquet(spark, f"{wh.root}/_messages/{feed.name}", "value binary")
        sink = parquet_batch_sink(feed, wh.raw_path(feed))
        checkpoint = f"{wh.root}/_checkpoints/{feed.name}"
        running.append(start_ingest(source, feed, sink, checkpoint, "framed_json", trigger=UNTIL_DRAINED))
    for query in running:
        query.awaitTermination()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("sparkelt-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = registry.queries()
    drain(registered["stg_green_taxi"](spark, SF_DIR))  # start the JVM's engines once

    seconds = {q: timed(lambda q=q: drain(registered[q](spark, SF_DIR))) for q in HEADLINE}

    # The whole chain: two drops of messages, each ingested into raw tables and then modelled.
    wh = Warehouse(spark, scratch_dir(spark, "bench"))
    raw = {f.name: raw_feed(spark, SF_DIR, f) for f in S.FEEDS.values()}
    trips = sum(df.count() for df in raw.values())
    ingest_seconds = 0.0
    for label, part in (("first", first_batch), ("second", second_batch)):
        for name, df in raw.items():  # publishing is not timed
            messages = to_messages(part(df), S.FEEDS[name], "framed_json").repartition(int(CPUS))
            messages.write.mode("append").parquet(f"{wh.root}/_messages/{name}")
        seconds[f"ingest_{label}_drop"] = timed(lambda: ingest(spark, wh))
        ingest_seconds += seconds[f"ingest_{label}_drop"]
        seconds[f"models_{label}_run"] = timed(lambda: P.run_models(wh))
    seconds["models_nothing_new"] = timed(lambda: P.run_models(wh))
    seconds["checks"] = timed(lambda: run_checks(P.tables(wh), P.CHECKS).collect())
    seconds["models_full_refresh"] = timed(lambda: P.run_models(wh, full_refresh=True))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "raw_trips": trips,
                "ingest_rows_per_sec": round(trips / ingest_seconds),
                "full_refresh_rows_per_sec": round(trips / seconds["models_full_refresh"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

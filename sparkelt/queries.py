"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt import schemas as S
from sparkelt.fixtures import first_batch, raw_feed, raw_from_lineitem, second_batch
from sparkelt.functions import columns as C
from sparkelt.functions.wire import (
    decode_by_schema_id,
    encode_json,
    extract_payload,
    frame,
    frame_body,
    frame_schema_id,
    normalize_payload,
)
from sparkelt.operators.dedup import dedup_latest
from sparkelt.operators.filters import drop_invalid, since
from sparkelt.operators.profile import profile
from sparkelt.operators.quality import CheckSpec, run_checks, violations
from sparkelt.operators.upsert import orphans_by_bitmap, upsert
from sparkelt.plans import models as M
from sparkelt.plans import pipeline as P
from sparkelt.plans.incremental import run_model, watermark
from sparkelt.sources.batches import RAW_FORMAT
from sparkelt.sources.readers import stream_parquet
from sparkelt.sources.storage import delete, letting_go, scratch_dir, size_of
from sparkelt.sources.warehouse import CODEC, Warehouse
from sparkelt.streaming.ingest import DEAD_LETTER, UNTIL_DRAINED, start_ingest
from sparkelt.streaming.publish import event_ordered, to_messages
from sparkelt.streaming.sinks import dead_letter_sink, parquet_batch_sink, read_dead_letters, start_file_sink
from sparkelt.streaming.state import start_dims, start_staging

Query = Callable[[SparkSession, str], DataFrame]

GREEN_SCHEMA_ID, YELLOW_SCHEMA_ID = 101, 102


def _green(spark: SparkSession, d: str) -> DataFrame:
    return raw_feed(spark, d, S.GREEN)


def _yellow(spark: SparkSession, d: str) -> DataFrame:
    return raw_feed(spark, d, S.YELLOW)


# --- staging ----------------------------------------------------------------------------------


def _trip_id_key(spark: SparkSession, d: str) -> DataFrame:
    ids = S.YELLOW.id_cols
    return _yellow(spark, d).select(C.trip_key("yellow", ids).alias("trip_id"), *ids)


def _stg(spark: SparkSession, d: str, feed: S.FeedSpec) -> DataFrame:
    return M.stg_taxi(raw_feed(spark, d, feed), feed)


def _stg_flags(spark: SparkSession, d: str) -> DataFrame:
    staged = _stg(spark, d, S.GREEN)
    return staged.select("trip_id", *[c for c in staged.columns if c.endswith("_flag")])


def _stg_code_clean(spark: SparkSession, d: str) -> DataFrame:
    return _stg(spark, d, S.YELLOW).select("trip_id", "ratecode_id_clean", "payment_id_clean")


# --- intermediate and mart --------------------------------------------------------------------


def _both(spark: SparkSession, d: str) -> DataFrame:
    return M.int_both_taxi(_stg(spark, d, S.GREEN), _stg(spark, d, S.YELLOW))


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return M.int_metrics_added(_both(spark, d))


def _trip_duration(spark: SparkSession, d: str) -> DataFrame:
    minutes = C.trip_duration("pickup_datetime", "dropoff_datetime").alias("trip_duration")
    return _stg(spark, d, S.YELLOW).select("trip_id", minutes)


def _night_weekend(spark: SparkSession, d: str) -> DataFrame:
    return _stg(spark, d, S.YELLOW).select(
        "trip_id",
        C.night_flag("pickup_datetime").alias("night_flag"),
        C.weekend_flag("pickup_datetime").alias("weekend_flag"),
    )


# --- incremental ------------------------------------------------------------------------------


def _watermark_filter(spark: SparkSession, d: str) -> DataFrame:
    raw = _yellow(spark, d)
    mark = watermark(M.stg_valid(first_batch(raw), S.YELLOW))
    return M.stg_taxi(since(raw, mark), S.YELLOW)


def _merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    raw = _yellow(spark, d)
    old, new = (M.stg_taxi(b, S.YELLOW) for b in (first_batch(raw), second_batch(raw)))
    return upsert(old, new, "trip_id")


def _two_runs_of_staging(spark: SparkSession, d: str, feed: S.FeedSpec) -> DataFrame:
    wh = Warehouse(spark, scratch_dir(spark, "two-batch"))
    raw, model = raw_feed(spark, d, feed), P.STAGING[feed.name]
    for seen in (first_batch(raw), raw):
        run_model(wh, model, {f"raw_{feed.name}": seen})
    return wh.read(model.table)


def _two_runs(spark: SparkSession, d: str, only: list[str]) -> Warehouse:
    wh = Warehouse(spark, scratch_dir(spark, "two-batch"), keep_replaced=False)
    raw = {f.name: raw_feed(spark, d, f) for f in S.FEEDS.values()}
    with letting_go(spark):
        P.run_models(wh, {name: first_batch(df) for name, df in raw.items()}, only=only)
        P.run_models(wh, raw, only=only)
    return wh


def _two_runs_of(model: str) -> Query:
    return lambda spark, d: _two_runs(spark, d, [model]).read(P.MODELS[model].table)


def _slow_feed(spark: SparkSession, d: str) -> DataFrame:
    """The fact after a second run that starts without stored marks, one feed far behind the other."""
    wh = Warehouse(spark, scratch_dir(spark, "slow-feed"))
    raw = {f.name: raw_feed(spark, d, f) for f in S.FEEDS.values()}
    P.run_models(wh, {"green": first_batch(raw["green"]), "yellow": raw["yellow"]}, only=["fact_trip"])
    wh.clear_marks(P.FACT.table)
    P.run_models(wh, raw, only=["fact_trip"])
    return wh.read(P.FACT.table)


def _two_runs_of_dims(spark: SparkSession, d: str) -> DataFrame:
    return _members_of(_two_runs(spark, d, list(P.DIMS)))


def _members_of(wh: Warehouse) -> DataFrame:
    """All dimensions in one shape."""
    out = None
    for dim in M.DIMENSIONS.values():
        one = wh.read(P.DIMS[dim.name].table).select(
            F.lit(dim.name).alias("dim"),
            F.col(dim.key).alias("member"),
            F.col(dim.label).alias("label"),
            "loaded_at",
        )
        out = one if out is None else out.unionByName(one)
    return out


def _both_feeds(of: Callable[[S.FeedSpec], DataFrame]) -> DataFrame:
    """One result per feed, told apart by ``taxi_type``; a column that a feed lacks is NULL there.

    The feeds share no table, so they run at the same time: small jobs and the planning between
    them, which a chain of batches is full of, leave most of a cluster idle.
    """
    with ThreadPoolExecutor(len(S.FEEDS)) as pool:
        found = [one.withColumn("taxi_type", F.lit(name)) for name, one in zip(S.FEEDS, pool.map(of, S.FEEDS.values()))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _late_merge(spark: SparkSession, d: str) -> DataFrame:
    """Staging from small units, into which the rows of the last half hour are merged."""
    wh = Warehouse(spark, scratch_dir(spark, "late"), unit_rows=500, small_bytes=0, keep_replaced=False)

    def staged(feed: S.FeedSpec) -> DataFrame:
        raw, model = raw_feed(spark, d, feed), P.STAGING[feed.name]
        for seen in (raw.filter("loaded_at <= TIMESTAMP_NTZ'2024-02-01 23:30:00'"), raw):
            run_model(wh, model, {f"raw_{feed.name}": seen})
        return wh.read(model.table)

    with letting_go(spark):
        return _both_feeds(staged)


# --- checks -----------------------------------------------------------------------------------


def _ungated(spark: SparkSession, d: str) -> DataFrame:
    """Raw yellow under domain names, nothing dropped, so that the checks find something."""
    renamed = [F.col(old).alias(new) for new, old in S.YELLOW.staged_columns.items()]
    return _yellow(spark, d).select(*renamed)


def _short_parents(trips: DataFrame) -> dict[str, DataFrame]:
    """Dimensions that deliberately lack some members."""
    places = trips.select(F.explode(F.array("pu_location_id", "do_location_id")).alias("location_id"))
    return {
        "dim_location": places.filter("location_id <= 200").distinct(),
        "dim_vendor": trips.select("vendor_id").filter("vendor_id IN (1, 2)").distinct(),
    }


def _dq(*specs: tuple) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        trips = _ungated(spark, d)
        checks = [CheckSpec("trips", *s) for s in specs]
        report = run_checks({"trips": trips, **_short_parents(trips)}, checks)
        return report.select("column_name", "failures")

    return run


def _dq_rows(*spec) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        trips = _ungated(spark, d)
        return violations(CheckSpec("trips", *spec), {"trips": trips, **_short_parents(trips)})

    return run


def _orphans_by_bitmap(spark: SparkSession, d: str) -> DataFrame:
    def missing(feed: S.FeedSpec) -> DataFrame:
        renamed = [F.col(old).alias(new) for new, old in feed.staged_columns.items()]
        trips = raw_feed(spark, d, feed).select(*renamed)
        return orphans_by_bitmap(trips, "pu_location_id", _short_parents(trips)["dim_location"], "location_id")

    return _both_feeds(missing)


_CODES = (S.UNKNOWN_CODE, *S.CLEAN_CODES)
_PRESENT = (
    "trip_id",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "ratecode_id",
    "payment_id",
    "loaded_at",
)


def _built(spark: SparkSession, d: str) -> Warehouse:
    wh = Warehouse(spark, scratch_dir(spark, "models"))
    P.run_models(wh, {f.name: raw_feed(spark, d, f) for f in S.FEEDS.values()})
    return wh


def _dq_report(spark: SparkSession, d: str) -> DataFrame:
    return run_checks(P.tables(_built(spark, d)), P.CHECKS)


def _dq_report_counted(spark: SparkSession, d: str) -> DataFrame:
    """The reports after two batches; the second counts what the second run wrote and sums."""
    wh = Warehouse(spark, scratch_dir(spark, "counted"))
    raw = {f.name: raw_feed(spark, d, f) for f in S.FEEDS.values()}
    first = P.run_pipeline(wh, {name: first_batch(df) for name, df in raw.items()})
    second = P.run_pipeline(wh, raw)
    return first.withColumn("batch", F.lit(1)).unionByName(second.withColumn("batch", F.lit(2)))


# --- codecs -----------------------------------------------------------------------------------


def _normalize(spark: SparkSession, d: str) -> DataFrame:
    return normalize_payload(event_ordered(_green(spark, d), S.GREEN), S.GREEN, keep=("trip_id",))


def _encode_json(spark: SparkSession, d: str) -> DataFrame:
    wire = normalize_payload(_green(spark, d), S.GREEN, keep=("trip_id",))
    return wire.select("trip_id", encode_json([n for n, _ in S.GREEN.wire]).alias("value"))


def _round_trip(fmt: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        messages = to_messages(_green(spark, d), S.GREEN, fmt)
        return extract_payload(messages, S.GREEN, fmt).select(*S.GREEN.load_schema.names)

    return run


def _decode_frame(spark: SparkSession, d: str) -> DataFrame:
    messages = to_messages(_green(spark, d), S.GREEN, "framed_json", schema_id=7, keep=("trip_id",))
    return messages.select(
        "trip_id",
        frame_schema_id("value").alias("schema_id"),
        F.length(frame_body("value")).alias("body_bytes"),
    )


def _decode_by_schema_id(spark: SparkSession, d: str) -> DataFrame:
    green = to_messages(_green(spark, d), S.GREEN, "framed_json", GREEN_SCHEMA_ID)
    yellow = to_messages(_yellow(spark, d), S.YELLOW, "framed_json", YELLOW_SCHEMA_ID)
    schemas = {GREEN_SCHEMA_ID: S.GREEN.wire_schema, YELLOW_SCHEMA_ID: S.YELLOW.wire_schema}
    return decode_by_schema_id(green.unionByName(yellow), schemas).drop("value")


#: Three versions of a feed's messages: fields that are left out, read as int, renamed, and added.
_VERSIONS = {
    201: (("congestion_surcharge", "improvement_surcharge"), ("passenger_count",), {}, ()),
    202: ((), ("RatecodeID", "payment_type"), {"fare_amount": "fare"}, ("note",)),
    203: ((), (), {}, ()),
}


def _written(feed: S.FeedSpec, version: int) -> T.StructType:
    """The writer's schema of a version."""
    left_out, narrow, renamed, added = _VERSIONS[version]
    fields = [f for f in feed.wire_schema.fields if f.name not in left_out]
    kinds = {n: T.IntegerType() for n in narrow}
    own = [T.StructField(renamed.get(f.name, f.name), kinds.get(f.name, f.dataType)) for f in fields]
    return T.StructType([*own, *[T.StructField(n, T.StringType()) for n in added]])


def _decode_evolved(spark: SparkSession, d: str) -> DataFrame:
    """Messages of three schema versions, by drop-off zone, read by the feed's schema of today."""

    def read(feed: S.FeedSpec) -> DataFrame:
        messages = None
        wire = normalize_payload(raw_feed(spark, d, feed), feed, keep=("trip_id",))
        for rest, version in enumerate(_VERSIONS):
            _, _, renamed, _ = _VERSIONS[version]
            rows = wire.filter(f"DOLocationID % 3 = {rest}").withColumn("note", F.lit("x")).withColumnsRenamed(renamed)
            body = encode_json(_written(feed, version).names).cast("binary")
            one = rows.select("trip_id", frame(body, version).alias("value"))
            messages = one if messages is None else messages.unionByName(one)
        schemas = {v: _written(feed, v) for v in _VERSIONS}
        defaults = {"congestion_surcharge": 0.0, "improvement_surcharge": None}
        return decode_by_schema_id(
            messages, schemas, reader=feed.wire_schema, defaults=defaults, aliases={"fare_amount": ["fare"]}
        ).drop("value")

    return _both_feeds(read)


# --- streaming --------------------------------------------------------------------------------


def _message_stream(spark: SparkSession, d: str, feed: S.FeedSpec, fmt: str) -> DataFrame:
    """The feed's messages as a bounded stream."""
    path = f"{d}/lineitem.parquet"
    lines = stream_parquet(spark, path, spark.read.parquet(path).schema)
    return to_messages(raw_from_lineitem(lines, feed), feed, fmt)


def _stream_ingest(feed: S.FeedSpec, fmt: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        wh = Warehouse(spark, scratch_dir(spark, "ingest"))
        messages = _message_stream(spark, d, feed, fmt)
        sink = parquet_batch_sink(feed, wh.raw_path(feed))
        query = start_ingest(messages, feed, sink, f"{wh.root}/_checkpoint", fmt, UNTIL_DRAINED)
        query.awaitTermination()
        return wh.read_raw(feed).drop("loaded_at")

    return run


def _stream_resume(spark: SparkSession, d: str) -> DataFrame:
    """Two drops of message files with a restart of the query in between; every row arrives once."""
    feed = S.YELLOW
    wh = Warehouse(spark, scratch_dir(spark, "resume"))
    drop = f"{wh.root}/_messages"
    raw = _yellow(spark, d)
    for batch in (first_batch(raw), second_batch(raw)):
        messages = to_messages(batch, feed, "json")
        messages.write.mode("append").parquet(drop)
        source = stream_parquet(spark, drop, messages.schema)
        sink = parquet_batch_sink(feed, wh.raw_path(feed))
        query = start_ingest(source, feed, sink, f"{wh.root}/_checkpoint", "json", UNTIL_DRAINED)
        query.awaitTermination()
    return wh.read_raw(feed).drop("loaded_at")


#: Bytes of ``lineitem`` whose messages go into a file.
FILE_BYTES = 8 << 20


def _ingested(wh: Warehouse, d: str, rows: DataFrame, feed: S.FeedSpec, batches: int) -> None:
    """A drop of messages, by trip, taken in by so many batches; their files grow in number, not in size.

    Rows move before they become messages, which are wider. Messages that were taken in are deleted.
    """
    drop = f"{wh.root}/_messages/{feed.name}"
    files = 1 + size_of(wh.spark, f"{d}/lineitem.parquet") // (batches * FILE_BYTES)
    by_trip = rows.drop("trip_id", "loaded_at").repartition(batches * files, *feed.id_cols)
    messages = to_messages(by_trip, feed, "json")
    messages.write.mode("append").option("compression", CODEC).parquet(drop)
    source = stream_parquet(wh.spark, drop, messages.schema, files)
    sink = parquet_batch_sink(feed, wh.raw_path(feed))
    checkpoint = f"{wh.root}/_checkpoints/{feed.name}"
    start_ingest(source, feed, sink, checkpoint, "json", UNTIL_DRAINED).awaitTermination()
    delete(wh.spark, drop)


def _stream_compaction(spark: SparkSession, d: str) -> DataFrame:
    """Both raw tables after several batches each, compacted and vacuumed."""
    wh = Warehouse(spark, scratch_dir(spark, "compaction"))

    def raw(feed: S.FeedSpec) -> DataFrame:
        _ingested(wh, d, raw_feed(spark, d, feed), feed, 6)
        wh.compact_raw(feed)
        wh.vacuum_raw(feed, timedelta(0))
        return wh.read_raw(feed).drop("loaded_at")

    with letting_go(spark):
        return _both_feeds(raw)


def _compacted_staging(spark: SparkSession, d: str) -> DataFrame:
    """Staging after each of two drops of several batches, the raw tables compacted after the first."""
    wh = Warehouse(spark, scratch_dir(spark, "compacted"), keep_replaced=False)
    with letting_go(spark):
        for part in (first_batch, second_batch):
            for feed in S.FEEDS.values():
                _ingested(wh, d, part(raw_feed(spark, d, feed)), feed, 3)
            P.run_models(wh, only=[f.staging_name for f in S.FEEDS.values()])
            for feed in S.FEEDS.values():
                wh.compact_raw(feed)
                wh.vacuum_raw(feed, timedelta(0))
    return _both_feeds(lambda f: wh.read(P.STAGING[f.name].table).select("trip_id", "fare_amount", "trip_distance"))


def spoilt(messages: DataFrame) -> DataFrame:
    """Messages (trip_id, value) of which some, by their trip_id, are malformed in one of four ways."""
    body = frame_body("value")
    unread = F.regexp_replace(body.cast("string"), '_pickup_datetime":"[^"]*"', '_pickup_datetime":"soon"')
    kind = F.substring("trip_id", 1, 1)
    value = (
        F.when(kind == "0", F.expr("substring(value, 1, length(value) - 3)"))
        .when(kind == "1", body)
        .when(kind == "2", F.lit(None))
        .when(kind == "3", F.concat(F.expr("substring(value, 1, 5)"), unread.cast("binary")))
        .otherwise(F.col("value"))
    )
    return messages.select(value.alias("value"))


def _dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of feeds with malformed messages: the raw tables' trips, and the dead letters."""
    wh = Warehouse(spark, scratch_dir(spark, "dead-letters"))

    def both_tables(feed: S.FeedSpec) -> DataFrame:
        path = f"{d}/lineitem.parquet"
        lines = stream_parquet(spark, path, spark.read.parquet(path).schema)
        messages = spoilt(to_messages(raw_from_lineitem(lines, feed), feed, "framed_json", 7, keep=("trip_id",)))
        dead = wh.dead_letter_path(feed)
        sink = dead_letter_sink(feed, wh.raw_path(feed), dead)
        checkpoint = f"{wh.root}/_checkpoints/{feed.name}"
        start_ingest(messages, feed, sink, checkpoint, "framed_json", UNTIL_DRAINED, DEAD_LETTER).awaitTermination()
        letters = read_dead_letters(spark, dead).select(
            F.lit(None).cast("string").alias("trip_id"),
            "reason",
            F.sha2("value", 256).alias("value_sha256"),
            F.length("value").cast("long").alias("value_bytes"),
        )
        return wh.read_raw(feed).select("trip_id").unionByName(letters, allowMissingColumns=True)

    return _both_feeds(both_tables)


def _stream_timer(spark: SparkSession, d: str) -> DataFrame:
    """Both feeds on a timer, with a second drop of messages while the queries run."""
    wh = Warehouse(spark, scratch_dir(spark, "timer"))

    def raw(feed: S.FeedSpec) -> DataFrame:
        drop = f"{wh.root}/_messages/{feed.name}"
        parts = [to_messages(part(raw_feed(spark, d, feed)), feed, "json") for part in (first_batch, second_batch)]
        parts[0].write.mode("append").parquet(drop)
        sink = parquet_batch_sink(feed, wh.raw_path(feed))
        source = stream_parquet(spark, drop, parts[0].schema)
        checkpoint = f"{wh.root}/_checkpoints/{feed.name}"
        query = start_ingest(source, feed, sink, checkpoint, "json", {"processingTime": "1 second"})
        try:
            query.processAllAvailable()
            parts[1].write.mode("append").parquet(drop)
            query.processAllAvailable()
        finally:
            query.stop()
        return wh.read_raw(feed).drop("loaded_at")

    return _both_feeds(raw)


def _drops(spark: SparkSession, raw: DataFrame, drop: str, parts: list, take: Callable) -> None:
    """Writes a part of the rows after the other into a folder; a new query over it takes each, which then goes."""
    for part in parts:
        rows = part(raw)
        rows.write.mode("append").options(**RAW_FORMAT).parquet(drop)
        take(stream_parquet(spark, drop, rows.schema)).awaitTermination()
        delete(spark, drop)


def _stream_staging(spark: SparkSession, d: str) -> DataFrame:
    """Both staging tables kept by streams. Rows come by half a month of pickup, but those loaded in the
    second half of the day half a month later, with a restart of the query after each drop."""
    wh = Warehouse(spark, scratch_dir(spark, "stream-staging"), keep_replaced=False)
    days = [f"TIMESTAMP_NTZ'2024-{day} 00:00:00'" for day in ("01-01", "01-17", "02-01", "02-11")]

    def staged(feed: S.FeedSpec) -> DataFrame:
        def part(n: int) -> Callable[[DataFrame], DataFrame]:
            def due(rows: DataFrame, n: int) -> DataFrame:
                inside = f"{feed.pickup} >= {days[n]} AND {feed.pickup} < {days[n + 1]}"
                return rows.filter(inside if n >= 0 else "FALSE")

            return lambda raw: due(first_batch(raw), n).unionByName(due(second_batch(raw), n - 1))

        def take(rows: DataFrame):
            return start_staging(rows, feed, wh, f"{wh.root}/_checkpoints/{feed.name}", "16 days", UNTIL_DRAINED)

        drop = f"{wh.root}/_drops/{feed.name}"
        _drops(spark, raw_feed(spark, d, feed), drop, [part(n) for n in range(3)], take)
        return wh.read(P.STAGING[feed.name].table)

    with letting_go(spark):
        return _both_feeds(staged)


def _stream_dims(spark: SparkSession, d: str) -> DataFrame:
    """The dimensions kept by a stream of the trips of two batches, with a restart in between."""
    wh = Warehouse(spark, scratch_dir(spark, "stream-dims"))

    def trips(part: Callable[[DataFrame], DataFrame]) -> DataFrame:
        green, yellow = (M.stg_taxi(part(raw_feed(spark, d, f)), f) for f in (S.GREEN, S.YELLOW))
        return M.int_metrics_added(M.int_both_taxi(green, yellow))

    def take(rows: DataFrame):
        return start_dims(rows, wh, f"{wh.root}/_checkpoints/dims", trigger=UNTIL_DRAINED)

    batches = [lambda _: trips(first_batch), lambda _: trips(second_batch)]
    _drops(spark, None, f"{wh.root}/_drops", batches, take)
    return _members_of(wh)


def _stream_json_sink(spark: SparkSession, d: str) -> DataFrame:
    feed, root = S.GREEN, scratch_dir(spark, "json")
    messages = _message_stream(spark, d, feed, "json")
    rows = extract_payload(messages, feed, "json", parse_times=False, with_key=False)
    out, checkpoint = f"{root}/out", f"{root}/_checkpoint"
    start_file_sink(rows, out, checkpoint, trigger=UNTIL_DRAINED).awaitTermination()
    return spark.read.schema(feed.wire_schema).json(out)


# --- registry ---------------------------------------------------------------------------------


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "raw_green": _green,
        "raw_yellow": _yellow,
        "profile_raw": lambda s, d: profile(_yellow(s, d)),
        "trip_id_key": _trip_id_key,
        "stg_drop_invalid": lambda s, d: drop_invalid(_yellow(s, d), S.YELLOW),
        "stg_dedup_latest": lambda s, d: dedup_latest(
            _yellow(s, d), ["trip_id"], ["loaded_at"], M.TIEBREAK
        ),
        "stg_code_clean": _stg_code_clean,
        "stg_flags": _stg_flags,
        "stg_green_taxi": lambda s, d: _stg(s, d, S.GREEN),
        "stg_yellow_taxi": lambda s, d: _stg(s, d, S.YELLOW),
        "int_both_taxi": _both,
        "trip_duration": _trip_duration,
        "night_weekend_flags": _night_weekend,
        "int_metrics_added": _metrics,
        "fact_trip": lambda s, d: M.fact_trip(_metrics(s, d)),
    }
    for dim in M.DIMENSIONS.values():
        out[dim.name] = lambda s, d, dim=dim: M.dim_table(_metrics(s, d), dim)
    links = [("pu_location_id", "dim_location", "location_id")]
    links += [("do_location_id", "dim_location", "location_id"), ("vendor_id", "dim_vendor", "vendor_id")]
    out |= {
        "inc_watermark_filter": _watermark_filter,
        "inc_merge_upsert": _merge_upsert,
        "inc_two_batch_stg": lambda s, d: _two_runs_of_staging(s, d, S.YELLOW),
        "inc_two_batch_stg_green": lambda s, d: _two_runs_of_staging(s, d, S.GREEN),
        "inc_two_batch_int": _two_runs_of("int_both_taxi"),
        "inc_two_batch_fact": _two_runs_of("fact_trip"),
        "inc_slow_feed": _slow_feed,
        "inc_merge_upsert_files": _late_merge,
        "inc_compacted_staging": _compacted_staging,
        "inc_two_batch_dims": _two_runs_of_dims,
        "dq_not_null": _dq(*[("not_null", c) for c in _PRESENT]),
        "dq_unique": _dq(("unique", "trip_id")),
        "dq_accepted_values": _dq(
            ("accepted_values", "vendor_id", S.VENDORS),
            ("accepted_values", "ratecode_id", _CODES),
            ("accepted_values", "payment_id", _CODES),
        ),
        "dq_dropoff_after_pickup": _dq(("dropoff_after_pickup",)),
        "dq_positive": _dq(*[("positive", c) for c in ("passenger_count", "trip_distance")]),
        "dq_positive_or_zero": _dq(*[("positive_or_zero", c) for c in S.YELLOW.amount_cols]),
        "dq_relationships": _dq(*[("relationships", c, (), to, pk) for c, to, pk in links]),
        "dq_violating_rows": _dq_rows("positive", "trip_distance"),
        "dq_duplicate_keys": _dq_rows("unique", "trip_id"),
        "dq_orphan_rows": _dq_rows("relationships", *links[0][:1], (), *links[0][1:]),
        "dq_orphan_rows_bitmap": _orphans_by_bitmap,
        "dq_report": _dq_report,
        "dq_report_counted": _dq_report_counted,
        "model_counts": lambda s, d: P.table_counts(_built(s, d)),
        "normalize_payload": _normalize,
        "encode_json": _encode_json,
        "decode_json": _round_trip("json"),
        "decode_frame": _decode_frame,
        "decode_by_schema_id": _decode_by_schema_id,
        "decode_evolved": _decode_evolved,
        "stream_ingest_green": _stream_ingest(S.GREEN, "framed_json"),
        "stream_ingest_yellow": _stream_ingest(S.YELLOW, "framed_json"),
        "stream_resume": _stream_resume,
        "stream_json_sink": _stream_json_sink,
        "stream_compaction": _stream_compaction,
        "stream_dead_letters": _dead_letters,
        "stream_timer": _stream_timer,
        "stream_staging": _stream_staging,
        "stream_dims": _stream_dims,
    }
    return out


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and mean duration by payment name, from the star schema."""
    metrics = _metrics(spark, sf_dir)
    return M.payment_summary(M.fact_trip(metrics), M.dim_table(metrics, M.DIMENSIONS["dim_payment"]))

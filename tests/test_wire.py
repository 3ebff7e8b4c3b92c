"""Frames, Avro and JSON."""

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt import schemas as S
from sparkelt.functions import wire as W
from sparkelt.streaming.publish import event_ordered, to_messages


def test_frame(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),), (bytearray(b""),), (None,)], "b binary")
    framed = df.select(W.frame("b", 258).alias("value"))
    assert bytes(framed.first()[0]) == b"\x00\x00\x00\x01\x02abc"
    got = framed.select(W.frame_schema_id("value"), W.frame_body("value")).collect()
    assert [(r[0], r[1] and bytes(r[1])) for r in got] == [(258, b"abc"), (258, b""), (None, None)]


def raw_green(spark, rows):
    return spark.createDataFrame(rows, S.GREEN.raw_schema)


@pytest.mark.parametrize("fmt", ["framed_json", "json"])
def test_messages_round_trip(spark, trip_row, fmt):
    rows = [trip_row(), trip_row(VendorID=None, ehail_fee=None, store_and_fwd_flag=None)]
    df = raw_green(spark, rows)
    back = W.extract_payload(to_messages(df, S.GREEN, fmt), S.GREEN, fmt)
    names = [n for n in S.GREEN.load_schema.names if n != "trip_id"]
    assert sorted(map(str, back.select(*names).collect())) == sorted(map(str, df.select(*names).collect()))


def test_tombstone_gives_an_empty_record_with_the_feed_hash(spark):
    df = spark.createDataFrame([(None,)], "value binary")
    only_feed = spark.range(1).select(F.sha2(F.lit("green"), 256)).first()[0]
    for fmt in ("framed_json", "json"):
        row = W.extract_payload(df, S.GREEN, fmt).first().asDict()
        assert row.pop("trip_id") == only_feed and set(row.values()) == {None}


def test_malformed_json_is_an_empty_record(spark):
    bodies = [b"{oops", b"", b'{"VendorID": 3, "lpep_pickup_datetime": "junk"}']
    df = spark.createDataFrame([(bytearray(b),) for b in bodies], "value binary")
    rows = W.extract_payload(df, S.GREEN, "json", mode="PERMISSIVE").drop("trip_id").collect()
    assert set(rows[0]) == {None} and set(rows[1]) == {None}
    assert rows[2]["VendorID"] == 3 and rows[2]["lpep_pickup_datetime"] is None


def test_malformed_frames_fail_or_yield_nulls_by_mode(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07{oops"),)], "value binary")
    row = W.extract_payload(df, S.GREEN, "framed_json", mode="PERMISSIVE").drop("trip_id").first()
    assert set(row) == {None}
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        W.extract_payload(df, S.GREEN, "framed_json", mode="FAILFAST").collect()


def test_avro_is_left_to_spark(spark):
    """The native functions are called; without their module Spark says which one to deploy."""
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07"),)], "value binary")
    try:
        W.extract_payload(df, S.GREEN, "avro").schema
    except (AnalysisException, TypeError) as e:
        assert "vro" in str(e) or "JavaPackage" in str(e)


def test_normalize_maps_nan_and_whole_numbers(spark):
    fields = {n: ("double" if t != "string" else "string") for n, t in S.GREEN.wire}
    fields["lpep_pickup_datetime"] = fields["lpep_dropoff_datetime"] = "timestamp_ntz"
    row = {n: (2.0 if t == "double" else None) for n, t in fields.items()}
    row |= {"passenger_count": float("nan"), "fare_amount": float("nan"), "VendorID": 2.0}
    row["lpep_pickup_datetime"] = datetime(2024, 1, 5, 10, 0, 0, 999999)
    ddl = ", ".join(f"{n} {t}" for n, t in fields.items())
    df = spark.createDataFrame([tuple(row[n] for n in fields)], ddl)
    got = W.normalize_payload(df, S.GREEN).first()
    assert got["passenger_count"] is None and got["fare_amount"] is None
    assert got["VendorID"] == 2 and isinstance(got["VendorID"], int)
    assert got["lpep_pickup_datetime"] == "2024-01-05T10:00:00"
    text = json.loads(bytes(to_messages(df, S.GREEN, "json").first()[0]))
    assert text["fare_amount"] is None and list(text) == [n for n, _ in S.GREEN.wire]


def test_event_order_is_global(spark, sf_dir):
    from sparkelt.fixtures import raw_feed

    times = [r[0] for r in event_ordered(raw_feed(spark, sf_dir, S.GREEN), S.GREEN).select(S.GREEN.pickup).collect()]
    assert times == sorted(times) and len(times) > 1000


def test_decode_by_schema_id(spark, trip_row):
    green = to_messages(raw_green(spark, [trip_row(VendorID=2)]), S.GREEN, "framed_json", schema_id=2)
    v1 = spark.createDataFrame([(bytearray(b'\x00\x00\x00\x00\x01{"VendorID": 7}'),)], "value binary")
    old = T.StructType([T.StructField("VendorID", T.LongType())])
    df = W.decode_by_schema_id(green.unionByName(v1), {1: old, 2: S.GREEN.wire_schema})
    got = {r.schema_id: (r.VendorID, r.fare_amount) for r in df.collect()}
    assert got == {2: (2, 10.0), 1: (7, None)}
    with pytest.raises(Exception, match="unknown schema id"):
        W.decode_by_schema_id(v1, {2: S.GREEN.wire_schema}).collect()
    lax = W.decode_by_schema_id(v1, {2: S.GREEN.wire_schema}, mode="PERMISSIVE")
    assert lax.first()["VendorID"] is None


def test_records_are_resolved_to_the_readers_schema(spark):
    old = T.StructType.fromDDL("a int, b string, gone string")
    new = T.StructType.fromDDL("a long, bb string, c double, d string")
    bodies = [(1, '{"a": 1, "b": "x", "gone": "y"}'), (1, '{"a": null, "b": null}'), (2, '{"a": 5, "bb": "z", "c": null, "d": "w"}')]
    messages = spark.createDataFrame(bodies, "id int, body string").select(
        F.concat(F.unhex(F.format_string("00%08X", "id")), F.col("body").cast("binary")).alias("value")
    )
    rules = {"reader": new, "defaults": {"c": 1.5, "d": None}, "aliases": {"bb": ["b"]}}
    got = W.decode_by_schema_id(messages, {1: old, 2: new}, **rules).drop("value")
    assert got.schema["a"].dataType == T.LongType() and got.columns == ["schema_id", "a", "bb", "c", "d"]
    assert [tuple(r) for r in got.collect()] == [(1, 1, "x", 1.5, None), (1, None, None, 1.5, None), (2, 5, "z", None, "w")]
    with pytest.raises(ValueError, match="'c' is not written"):
        W.decode_by_schema_id(messages, {1: old, 2: new}, reader=new, aliases={"bb": ["b"]})
    narrow = T.StructType.fromDDL("a int")
    with pytest.raises(ValueError, match="bigint and cannot be read as int"):
        W.decode_by_schema_id(messages, {1: old, 2: new}, reader=narrow)

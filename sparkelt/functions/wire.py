"""Message codecs: registry frame, Avro body, JSON text. Column in, Column out."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt.functions.columns import iso_seconds, parse_timestamp, trip_key
from sparkelt.schemas import FeedSpec

# --- fixed values: the registry frame is one zero byte, a 4-byte big-endian schema id, the body ---
FRAME_BYTES = 5


# --- frame ------------------------------------------------------------------------------------


def frame_body(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.substring(value, F.lit(FRAME_BYTES + 1), F.length(value) - FRAME_BYTES)


def frame_schema_id(value: Column | str) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")


def frame(body: Column | str, schema_id: int) -> Column:
    body = F.col(body) if isinstance(body, str) else body
    return F.concat(F.unhex(F.lit(f"00{schema_id:08X}")), body)


# --- Avro -------------------------------------------------------------------------------------
# Spark's own functions; they need the spark-avro module on the class path.


def decode_avro(body: Column, avro_json: str, mode: str = "FAILFAST") -> Column:
    """Avro body to a struct column. ``mode`` as in from_avro: FAILFAST or PERMISSIVE."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(body, avro_json, {"mode": mode})


def encode_avro(record: Column, avro_json: str) -> Column:
    """Struct column to an Avro body."""
    from pyspark.sql.avro.functions import to_avro

    return to_avro(record, avro_json)


# --- frames by writer schema ------------------------------------------------------------------


#: Writer and reader types between which a value may be read. Fixed values.
PROMOTIONS = {
    "int": ("bigint", "float", "double"),
    "bigint": ("float", "double"),
    "float": ("double",),
    "string": ("binary",),
    "binary": ("string",),
}


def resolved(
    record: Column,
    writer: T.StructType,
    reader: T.StructType,
    defaults: Mapping[str, object] | None = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> Column:
    """A writer's record as the reader's struct.

    Fields meet by name, else by the reader's ``aliases``, its names of earlier versions. A field
    that the writer lacks takes its default; a NULL that the writer did write stays. Fields that the
    reader lacks go, and narrower types are promoted. A field without writer and default, or a type
    that does not promote, is a ValueError when the plan is made, not when a message comes. A NULL
    record stays NULL.
    """
    defaults, aliases = defaults or {}, aliases or {}
    out = []
    for field in reader.fields:
        found = next((n for n in (field.name, *aliases.get(field.name, ())) if n in writer.names), None)
        target = field.dataType.simpleString()
        if found is None:
            if field.name not in defaults:
                raise ValueError(f"{field.name!r} is not written and has no default")
            out.append(F.lit(defaults[field.name]).cast(field.dataType).alias(field.name))
            continue
        source = writer[found].dataType.simpleString()
        if source != target and target not in PROMOTIONS.get(source, ()):
            raise ValueError(f"{field.name!r} is written as {source} and cannot be read as {target}")
        out.append(record[found].cast(field.dataType).alias(field.name))
    return F.when(record.isNotNull(), F.struct(*out))


def decode_by_schema_id(
    df: DataFrame,
    schemas: dict[int, str | T.StructType],
    value: str = "value",
    mode: str = "FAILFAST",
    reader: T.StructType | None = None,
    defaults: Mapping[str, object] | None = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Decode frames by the writer schema each one names.

    Columns are those of ``reader``, to which every writer's records are resolved (see ``resolved``),
    or without one the union over all schemas. A schema is a struct type for JSON bodies, or an Avro
    schema as text for Avro bodies. The input is read once: each decoder gets the body of its own
    frames and NULL for the others. A frame with an unknown id is an error, or an all-NULL record in
    PERMISSIVE mode.
    """
    sid = frame_schema_id(value)
    nothing = F.lit(None).cast("binary")
    if mode.upper() == "PERMISSIVE":
        other = nothing
    else:
        trouble = F.raise_error(F.concat(F.lit("unknown schema id "), sid.cast("string")))
        other = F.when(sid.isNull() | sid.isin(*schemas), nothing).otherwise(trouble.cast("binary"))

    def decoded(i: int, schema: str | T.StructType) -> Column:
        body = F.when(sid == i, frame_body(value)).otherwise(other)
        return decode_avro(body, schema, mode) if isinstance(schema, str) else decode_json(body, schema, mode)

    def names(schema: str | T.StructType) -> list[str]:
        if isinstance(schema, str):
            return [f["name"] for f in json.loads(schema)["fields"]]
        return schema.names

    records = {f"_r{i}": decoded(i, schema) for i, schema in schemas.items()}
    out = df.withColumns({"schema_id": sid, **records})
    if reader is not None:
        one = [resolved(F.col(r), out.schema[r].dataType, reader, defaults, aliases) for r in records]
        whole = out.withColumn("_record", F.coalesce(*one)).drop(*records)
        return whole.withColumns({n: F.col("_record")[n] for n in reader.names}).drop("_record")
    fields: dict[str, list[Column]] = {}
    for i, schema in schemas.items():
        for name in names(schema):
            fields.setdefault(name, []).append(F.col(f"_r{i}")[name])
    return out.withColumns({n: F.coalesce(*cs) for n, cs in fields.items()}).drop(*records)


# --- JSON -------------------------------------------------------------------------------------


def decode_json(value: Column | str, schema: T.StructType, mode: str = "PERMISSIVE") -> Column:
    """JSON text (or its bytes) to a struct. Malformed text: a record of NULLs, or FAILFAST."""
    value = F.col(value) if isinstance(value, str) else value
    return F.from_json(value.cast("string"), schema, {"mode": mode})


def encode_json(names: list[str]) -> Column:
    """The named columns as one JSON object, explicit nulls included."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


# --- record <-> feed columns ------------------------------------------------------------------


def extract_payload(
    df: DataFrame,
    feed: FeedSpec,
    fmt: str = "avro",
    value: str = "value",
    keep: tuple[str, ...] = (),
    parse_times: bool = True,
    with_key: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Messages to feed columns: decode, flatten, parse timestamps, add the trip key.

    ``fmt`` is "avro" (framed), "framed_json" or "json"; ``mode`` says what a malformed body does.
    Works on batch and streaming frames alike; every step is narrow.
    """
    if fmt == "avro":
        record = decode_avro(frame_body(value), feed.avro_json, mode)
    elif fmt == "framed_json":
        record = decode_json(frame_body(value), feed.wire_schema, mode)
    elif fmt == "json":
        record = decode_json(value, feed.wire_schema, mode)
    else:
        raise ValueError(f"unknown message format {fmt!r}")
    out = df.select(*keep, record.alias("data")).select(*keep, "data.*")
    if parse_times:
        out = out.withColumns({c: parse_timestamp(c) for c in feed.timestamp_cols})
    if with_key:
        out = out.withColumn("trip_id", trip_key(feed.name, feed.id_cols))
    return out


def judge_payload(df: DataFrame, feed: FeedSpec, fmt: str = "avro", value: str = "value") -> DataFrame:
    """Messages to feed columns as ``extract_payload`` does, with the message and ``reason``.

    ``reason`` is NULL for a good message, else the first that holds: ``no value``, ``no frame`` (too
    short, or another first byte), ``malformed body``, ``unreadable time``. Each message is decoded
    once.
    """
    message = F.col(value).cast("binary")
    framed = fmt != "json"
    body = frame_body(message) if framed else message
    if fmt == "avro":
        record = decode_avro(body, feed.avro_json, "PERMISSIVE")
    elif fmt in ("framed_json", "json"):
        schema = T.StructType([*feed.wire_schema.fields, T.StructField("_broken", T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
        record = F.from_json(body.cast("string"), schema, options)
    else:
        raise ValueError(f"unknown message format {fmt!r}")
    names = [n for n, _ in feed.wire]
    out = df.select(message.alias("value"), record.alias("data"))
    if fmt == "avro":  # a malformed body decodes to a record of NULLs
        broken = F.coalesce(*[F.col("data")[n].cast("string") for n in names]).isNull()
    else:
        broken = F.col("data").isNull() | F.col("data._broken").isNotNull()
    times = {c: parse_timestamp(F.col("data")[c]) for c in feed.timestamp_cols}
    unread = [F.col("data")[c].isNotNull() & t.isNull() for c, t in times.items()]
    reason = F.when(F.col("value").isNull(), "no value")
    if framed:
        bare = (F.length("value") < FRAME_BYTES) | (F.hex(F.substring("value", 1, 1)) != "00")
        reason = reason.when(bare, "no frame")
    reason = reason.when(broken, "malformed body").when(reduce(or_, unread), "unreadable time")
    columns = [times.get(n, F.col("data")[n]).alias(n) for n in names]
    out = out.select("value", reason.alias("reason"), *columns)
    return out.withColumn("trip_id", trip_key(feed.name, feed.id_cols))


def normalize_payload(df: DataFrame, feed: FeedSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feed columns to wire values: ISO text timestamps, NaN to NULL, codes as whole numbers."""
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}

    def wire(name: str, target: str) -> Column:
        kind = kinds[name.lower()]
        c = F.col(name)
        if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            return iso_seconds(c).alias(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return c.cast({"long": "bigint"}.get(target, target)).alias(name)

    return df.select(*keep, *[wire(n, t) for n, t in feed.wire])


def wire_struct(feed: FeedSpec) -> Column:
    return F.struct(*[n for n, _ in feed.wire])

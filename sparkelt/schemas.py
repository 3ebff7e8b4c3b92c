"""Feed, raw-table and model-table schemas: the one place where names and types are declared."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

LONG, DOUBLE, TEXT, STAMP = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# --- fixed values: wire records (field order decides the Avro bytes; every field is nullable) ---
GREEN_WIRE = (
    ("VendorID", "long"),
    ("lpep_pickup_datetime", "string"),
    ("lpep_dropoff_datetime", "string"),
    ("store_and_fwd_flag", "string"),
    ("RatecodeID", "long"),
    ("PULocationID", "long"),
    ("DOLocationID", "long"),
    ("passenger_count", "long"),
    ("trip_distance", "double"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("ehail_fee", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("payment_type", "long"),
    ("trip_type", "long"),
    ("congestion_surcharge", "double"),
)
YELLOW_WIRE = (
    ("VendorID", "long"),
    ("tpep_pickup_datetime", "string"),
    ("tpep_dropoff_datetime", "string"),
    ("passenger_count", "long"),
    ("trip_distance", "double"),
    ("RatecodeID", "long"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "long"),
    ("DOLocationID", "long"),
    ("payment_type", "long"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("Airport_fee", "double"),
)

# --- fixed values: accepted codes and display labels ---
CLEAN_CODES = (1, 2, 3, 4, 5, 6)
UNKNOWN_CODE = -1
TRIP_TYPES = (1, 2)
VENDORS = (1, 2)
FEED_NAMES = ("green", "yellow")
REJECTED_FLAGS = ("missing", "invalid")
VENDOR_LABELS = {1: "Vendor One", 2: "Vendor Two"}
VENDOR_DEFAULT = "Unknown Vendor"
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Other"
RATECODE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
RATECODE_DEFAULT = "Unknown Ratecode"
TRIP_TYPE_LABELS = {1: "Street-hail", 2: "Dispatch"}
TRIP_TYPE_DEFAULT = "Unknown Trip Type"

_SPARK_TYPES = {"long": LONG, "double": DOUBLE, "string": TEXT}

# Amounts judged by the four-way rule in both feeds; each feed adds its own fee before the total.
SHARED_AMOUNTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
)


@dataclass(frozen=True)
class FeedSpec:
    """Everything that differs between the two feeds."""

    name: str
    prefix: str
    wire: tuple[tuple[str, str], ...]
    fee: str
    fee_source: str
    has_trip_type: bool

    @property
    def topic(self) -> str:
        return f"{self.name}-taxi"

    @property
    def raw_name(self) -> str:
        return f"{self.name}_taxi"

    @property
    def staging_name(self) -> str:
        return f"stg_{self.name}_taxi"

    @property
    def pickup(self) -> str:
        return f"{self.prefix}_pickup_datetime"

    @property
    def dropoff(self) -> str:
        return f"{self.prefix}_dropoff_datetime"

    @property
    def timestamp_cols(self) -> tuple[str, str]:
        return (self.pickup, self.dropoff)

    @property
    def id_cols(self) -> tuple[str, ...]:
        return ("VendorID", self.pickup, self.dropoff, "PULocationID", "DOLocationID")

    @property
    def wire_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _SPARK_TYPES[t]) for n, t in self.wire])

    @property
    def load_schema(self) -> T.StructType:
        """Columns an ingest batch delivers: the key, then the wire fields with real timestamps."""
        fields = [T.StructField("trip_id", TEXT)]
        for n, t in self.wire:
            fields.append(T.StructField(n, STAMP if n in self.timestamp_cols else _SPARK_TYPES[t]))
        return T.StructType(fields)

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([*self.load_schema.fields, T.StructField("loaded_at", STAMP)])

    @property
    def avro_json(self) -> str:
        fields = [{"name": n, "type": ["null", t], "default": None} for n, t in self.wire]
        name = f"{self.name.capitalize()}Trip"
        return json.dumps({"type": "record", "name": name, "fields": fields})

    @property
    def staged_columns(self) -> dict[str, str]:
        """Domain name -> raw name, in staging order."""
        cols = {
            "trip_id": "trip_id",
            "vendor_id": "VendorID",
            "pickup_datetime": self.pickup,
            "dropoff_datetime": self.dropoff,
            "pu_location_id": "PULocationID",
            "do_location_id": "DOLocationID",
            "ratecode_id": "RatecodeID",
            "payment_id": "payment_type",
        }
        same = ["passenger_count", "trip_distance", *SHARED_AMOUNTS]
        cols.update({c: c for c in same})
        cols[self.fee] = self.fee_source
        cols["total_amount"] = "total_amount"
        if self.has_trip_type:
            cols["trip_type"] = "trip_type"
        cols["loaded_at"] = "loaded_at"
        return cols

    @property
    def amount_cols(self) -> tuple[str, ...]:
        return (*SHARED_AMOUNTS, self.fee, "total_amount")


GREEN = FeedSpec("green", "lpep", GREEN_WIRE, "ehail_fee", "ehail_fee", True)
YELLOW = FeedSpec("yellow", "tpep", YELLOW_WIRE, "airport_fee", "Airport_fee", False)
FEEDS = {f.name: f for f in (GREEN, YELLOW)}


def _struct(spec: str) -> T.StructType:
    kinds = {"l": LONG, "d": DOUBLE, "s": TEXT, "t": STAMP, "i": T.IntegerType()}
    pairs = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(n, kinds[k]) for n, k in pairs])


def staging_schema(feed: FeedSpec) -> T.StructType:
    raw = {f.name: f.dataType for f in feed.raw_schema.fields}
    fields = [T.StructField(new, raw[old]) for new, old in feed.staged_columns.items()]
    fields += [T.StructField(c, LONG) for c in ("ratecode_id_clean", "payment_id_clean")]
    judged = ["passenger_count", "trip_distance", *feed.amount_cols]
    if feed.has_trip_type:
        judged.append("trip_type")
    fields += [T.StructField(f"{c}_flag", TEXT) for c in judged]
    return T.StructType(fields)


INT_BOTH_SCHEMA = _struct(
    "trip_id:s vendor_id:l pickup_datetime:t dropoff_datetime:t pu_location_id:l do_location_id:l "
    "ratecode_id:l payment_id:l passenger_count:l trip_distance:d fare_amount:d extra:d mta_tax:d "
    "tip_amount:d tolls_amount:d improvement_surcharge:d congestion_surcharge:d ehail_fee:d "
    "airport_fee:d total_amount:d trip_type:l taxi_type:s loaded_at:t"
)
INT_METRICS_SCHEMA = _struct(
    "trip_id:s vendor_id:l pickup_datetime:t dropoff_datetime:t pu_location_id:l do_location_id:l "
    "ratecode_id:l payment_id:l passenger_count:l trip_distance:d trip_duration:d fare_amount:d "
    "extra:d mta_tax:d tip_amount:d tolls_amount:d improvement_surcharge:d congestion_surcharge:d "
    "ehail_fee:d airport_fee:d total_amount:d trip_type_id:l taxi_type:s night_flag:i weekend_flag:i "
    "loaded_at:t"
)
FACT_SCHEMA = _struct(
    "trip_id:s vendor_id:l trip_type_id:l pickup_datetime:t dropoff_datetime:t pu_location_id:l "
    "do_location_id:l ratecode_id:l payment_id:l passenger_count:l trip_distance:d trip_duration:d "
    "fare_amount:d extra:d mta_tax:d tip_amount:d tolls_amount:d improvement_surcharge:d "
    "congestion_surcharge:d ehail_fee:d airport_fee:d total_amount:d night_flag:i weekend_flag:i "
    "loaded_at:t"
)

# The thirteen flags that decide whether a trip leaves staging.
GATE_FLAGS = tuple(
    f"{c}_flag"
    for c in (
        "passenger_count",
        "trip_distance",
        *SHARED_AMOUNTS,
        "total_amount",
        "ehail_fee",
        "airport_fee",
        "trip_type",
    )
)


def dim_schema(key: str, label: str) -> T.StructType:
    return _struct(f"{key}:l {label}:s loaded_at:t")

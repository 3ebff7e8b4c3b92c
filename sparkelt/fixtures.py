"""Adapter from the test data's ``lineitem`` table to the two raw feeds (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkelt.functions.columns import trip_key
from sparkelt.schemas import FeedSpec

BATCH_1_END = datetime(2024, 2, 1, 12, 0, 0)

_MONEY = {
    "fare_amount": ("l_extendedprice", 83),
    "total_amount": ("l_extendedprice", 47),
    "extra": ("l_discount", 79),
    "tip_amount": ("l_discount", 71),
    "congestion_surcharge": ("l_discount", 59),
    "mta_tax": ("l_tax", 73),
    "tolls_amount": ("l_tax", 67),
    "improvement_surcharge": ("l_tax", 61),
    "ehail_fee": ("l_discount", 43),
    "Airport_fee": ("l_discount", 53),
}


def _money(source: str, m: int) -> str:
    return (
        f"CASE WHEN l_partkey % {m} = 0 THEN NULL WHEN l_partkey % {m} = 1 THEN CAST(-1 AS DOUBLE) "
        f"ELSE {source} END"
    )


def raw_from_lineitem(lineitem: DataFrame, feed: FeedSpec) -> DataFrame:
    """A narrow projection, so it works on batch and streaming frames."""
    mine = "l_returnflag = 'R'" if feed.name == "green" else "l_returnflag <> 'R'"
    pickup = (
        "timestampadd(MINUTE, (l_orderkey*37 + l_linenumber*11) % 44640, "
        "TIMESTAMP_NTZ '2024-01-01 00:00:00')"
    )
    dropoff = f"timestampadd(SECOND, (l_orderkey*31 + l_linenumber*17) % 3600 - 60, {pickup})"
    made = {
        "VendorID": "CASE WHEN l_orderkey % 50 = 49 THEN NULL "
        "WHEN l_orderkey % 50 = 48 THEN CAST(3 AS BIGINT) ELSE 1 + l_orderkey % 2 END",
        feed.pickup: pickup,
        feed.dropoff: dropoff,
        "store_and_fwd_flag": "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END",
        "RatecodeID": "NULLIF(l_suppkey % 9, 8)",
        "PULocationID": "CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE l_orderkey % 265 + 1 END",
        "DOLocationID": "(l_orderkey*7 + l_linenumber) % 265 + 1",
        "passenger_count": "NULLIF(l_partkey % 8, 7)",
        "trip_distance": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_quantity - 2 END",
        "payment_type": "CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END",
        "trip_type": "CASE WHEN l_partkey % 37 = 0 THEN NULL "
        "WHEN l_partkey % 37 = 1 THEN CAST(3 AS BIGINT) ELSE 1 + l_partkey % 2 END",
        "loaded_at": "timestampadd(SECOND, (l_partkey*1000003 + l_suppkey*7919) % 86400, "
        "TIMESTAMP_NTZ '2024-02-01 00:00:00')",
    } | {name: _money(*rule) for name, rule in _MONEY.items()}

    def col(name: str) -> Column:
        return F.expr(made[name]).alias(name)

    wanted = [n for n in feed.raw_schema.names if n != "trip_id"]
    trips = lineitem.filter(mine).select(*[col(n) for n in wanted])
    return trips.select(trip_key(feed.name, feed.id_cols).alias("trip_id"), *wanted)


def raw_feed(spark: SparkSession, sf_dir: str, feed: FeedSpec) -> DataFrame:
    return raw_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), feed)


def first_batch(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("loaded_at") <= F.lit(BATCH_1_END.isoformat(sep=" ")).cast("timestamp_ntz"))


def second_batch(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("loaded_at") > F.lit(BATCH_1_END.isoformat(sep=" ")).cast("timestamp_ntz"))

"""The models as pure functions of DataFrames: the same code serves batch and incremental runs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt import schemas as S
from sparkelt.functions import columns as C
from sparkelt.operators.dedup import dedup_latest
from sparkelt.operators.filters import drop_invalid, quality_gate

TIEBREAK = ("fare_amount", "trip_distance")


def _project(df: DataFrame, schema: T.StructType, made: dict[str, Column] | None = None) -> DataFrame:
    """Select exactly the schema's columns; ``made`` supplies the computed or renamed ones.

    A ``slice``, the place of a stored row, is passed on where the rows bring one.
    """
    made = made or {}
    place = ["slice"] if "slice" in df.columns else []
    return df.select(*[made.get(n, F.col(n)).alias(n) for n in schema.names], *place)


# --- staging ----------------------------------------------------------------------------------


def stg_valid(raw: DataFrame, feed: S.FeedSpec) -> DataFrame:
    """Valid trips under domain names, all versions of each."""
    return drop_invalid(raw, feed).select(
        *[F.col(old).alias(new) for new, old in feed.staged_columns.items()]
    )


def stg_newest(valid: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Newest version of each trip; ``within`` names columns that all versions of a trip share."""
    return dedup_latest(valid, [*within, "trip_id"], ["loaded_at"], TIEBREAK)


def stg_flags(core: DataFrame, feed: S.FeedSpec) -> DataFrame:
    """Adds the cleaned codes and one flag per judged column."""
    made = {f"{c}_clean": C.code_clean(c) for c in ("ratecode_id", "payment_id")}
    made |= {f"{c}_flag": C.positive_flag(c) for c in ("passenger_count", "trip_distance")}
    made |= {f"{c}_flag": C.amount_flag(c) for c in feed.amount_cols}
    if feed.has_trip_type:
        made["trip_type_flag"] = C.enum_flag("trip_type", S.TRIP_TYPES)
    return core.withColumns(made)


def stg_taxi(raw: DataFrame, feed: S.FeedSpec) -> DataFrame:
    return stg_flags(stg_newest(stg_valid(raw, feed)), feed)


# --- intermediate -----------------------------------------------------------------------------

_ALIGNED = T.StructType(
    [f for f in S.INT_BOTH_SCHEMA.fields] + [T.StructField(n, S.TEXT) for n in S.GATE_FLAGS]
)


def _align(staged: DataFrame, feed: S.FeedSpec) -> DataFrame:
    """A staged feed in the shared shape; what the feed lacks becomes a neutral constant."""
    made = {
        "ratecode_id": F.col("ratecode_id_clean"),
        "payment_id": F.col("payment_id_clean"),
        "taxi_type": F.lit(feed.name),
    }
    for fee in {f.fee for f in S.FEEDS.values()} - {feed.fee}:
        made[fee] = F.lit(0).cast("double")
        made[f"{fee}_flag"] = F.lit("not_applicable")
    if not feed.has_trip_type:
        made["trip_type"] = F.lit(1).cast("long")
        made["trip_type_flag"] = F.lit("not_applicable")
    return _project(staged, _ALIGNED, made)


def int_both_taxi(stg_green: DataFrame, stg_yellow: DataFrame) -> DataFrame:
    """Both feeds in one table, trips of acceptable quality only. Narrow: no shuffle."""
    both = _align(stg_green, S.GREEN).unionByName(_align(stg_yellow, S.YELLOW))
    return _project(quality_gate(both), S.INT_BOTH_SCHEMA)


def int_metrics_added(int_both: DataFrame) -> DataFrame:
    return _project(
        int_both,
        S.INT_METRICS_SCHEMA,
        {
            "trip_duration": C.trip_duration("pickup_datetime", "dropoff_datetime"),
            "night_flag": C.night_flag("pickup_datetime"),
            "weekend_flag": C.weekend_flag("pickup_datetime"),
            "trip_type_id": F.col("trip_type"),
        },
    )


# --- mart -------------------------------------------------------------------------------------


def fact_trip(metrics: DataFrame) -> DataFrame:
    return _project(metrics, S.FACT_SCHEMA)


@dataclass(frozen=True)
class Dimension:
    """A dimension: where its members come from and how they are named."""

    name: str
    key: str
    label: str
    columns: tuple[str, ...]

    def title(self, c: Column | str) -> Column:
        if self.key == "location_id":
            return C.location_name(c)
        return C.label_map(c, *_LABELS[self.key])

    @property
    def schema(self) -> T.StructType:
        return S.dim_schema(self.key, self.label)


_LABELS = {
    "vendor_id": (S.VENDOR_LABELS, S.VENDOR_DEFAULT),
    "payment_id": (S.PAYMENT_LABELS, S.PAYMENT_DEFAULT),
    "ratecode_id": (S.RATECODE_LABELS, S.RATECODE_DEFAULT),
    "trip_type_id": (S.TRIP_TYPE_LABELS, S.TRIP_TYPE_DEFAULT),
}
DIMENSIONS = {
    d.name: d
    for d in (
        Dimension("dim_vendor", "vendor_id", "vendor_name", ("vendor_id",)),
        Dimension("dim_payment", "payment_id", "payment_name", ("payment_id",)),
        Dimension("dim_ratecode", "ratecode_id", "ratecode_name", ("ratecode_id",)),
        Dimension("dim_trip_type", "trip_type_id", "trip_type_name", ("trip_type_id",)),
        Dimension(
            "dim_location", "location_id", "location_name", ("pu_location_id", "do_location_id")
        ),
    )
}


def dim_members(metrics: DataFrame, dims: Iterable[Dimension]) -> DataFrame:
    """(dim, key, loaded_at) of all given dimensions from one scan of the trips.

    Every trip contributes one pair per source column; pairs are combined on the map side, so the
    shuffle carries distinct members only, however many trips share one. Rows are grouped by the
    dimension's number, which is cheaper to hash than its name.
    """
    dims = list(dims)
    pairs = [
        F.struct(F.lit(i).alias("_dim"), F.col(c).alias("key"))
        for i, d in enumerate(dims)
        for c in d.columns
    ]
    exploded = metrics.select("loaded_at", F.inline(F.array(*pairs)))
    found = exploded.groupBy("_dim", "key").agg(F.max("loaded_at").alias("loaded_at"))
    names = F.array(*[F.lit(d.name) for d in dims])
    return found.select(names[F.col("_dim")].alias("dim"), "key", "loaded_at")


def dim_from_members(members: DataFrame, dim: Dimension) -> DataFrame:
    """One dimension out of the shared member list."""
    own = members.filter(F.col("dim") == dim.name)
    return own.select(F.col("key").alias(dim.key), dim.title("key").alias(dim.label), "loaded_at")


def dim_table(metrics: DataFrame, dim: Dimension) -> DataFrame:
    """One dimension straight from the trips."""
    if len(dim.columns) > 1:
        return dim_from_members(dim_members(metrics, [dim]), dim)
    found = metrics.groupBy(dim.key).agg(F.max("loaded_at").alias("loaded_at"))
    return found.select(dim.key, dim.title(dim.key).alias(dim.label), "loaded_at")


def payment_summary(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Trips and mean duration by payment name: a typical use of the star schema.

    The fact is reduced to one row per code before it meets the dimension.
    """
    by_code = fact.groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("trip_duration").alias("mean_duration")
    )
    named = by_code.join(dim_payment.select("payment_id", "payment_name"), "payment_id")
    return named.select("payment_name", "trips", "mean_duration").orderBy("payment_name")

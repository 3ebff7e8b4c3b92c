"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkelt.schemas import GATE_FLAGS, REJECTED_FLAGS, FeedSpec


def drop_invalid(raw: DataFrame, feed: FeedSpec) -> DataFrame:
    """Keep trips that have their key and all mandatory fields and end after they start.

    One plain predicate per column, so that each can be pushed to the scan.
    """
    present = [F.col(c).isNotNull() for c in (*feed.id_cols, "trip_id")]
    return raw.filter(reduce(and_, present)).filter(F.col(feed.dropoff) > F.col(feed.pickup))


def quality_gate(df: DataFrame, flags: Iterable[str] = GATE_FLAGS) -> DataFrame:
    """Keep rows none of whose flags is a rejected one. A NULL flag does not pass."""
    return df.filter(reduce(and_, [~F.col(f).isin(*REJECTED_FLAGS) for f in flags]))


Marks = Mapping[str, datetime | None]


def since(df: DataFrame, watermark: datetime | None) -> DataFrame:
    """Rows loaded strictly after the watermark; no watermark means every row."""
    return df if watermark is None else df.filter(_newer(watermark))


def since_marks(df: DataFrame, marks: Marks, feed_col: str = "taxi_type") -> DataFrame:
    """As ``since`` with one watermark per feed; a feed without a watermark is taken whole."""
    if all(m is None for m in marks.values()):
        return df
    fresh = [
        (F.col(feed_col) == feed) & (F.lit(True) if mark is None else _newer(mark))
        for feed, mark in marks.items()
    ]
    # Repeats the weakest bound outside the OR so that it can reach the scan on its own.
    oldest = min((m for m in marks.values() if m is not None), default=None)
    if all(m is not None for m in marks.values()):
        df = df.filter(_newer(oldest))
    return df.filter(reduce(or_, fresh))


def _newer(mark: datetime) -> Column:
    return F.col("loaded_at") > stamp(mark)


def stamp(moment: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")

"""Dataset profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count, and non-NULL count, minimum and maximum per column, in one pass."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in columns or df.columns:
        aggs += [
            F.count(c).alias(f"{c}_non_null"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return df.agg(*aggs)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first few rows; reads no more partitions than it needs."""
    return df.limit(n)

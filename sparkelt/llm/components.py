"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def stars(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(u, v): every linked node but the smallest of its component, with that smallest node.

    ``edges`` holds (u, v) as longs. Links stay in the cluster; each round is written to shared
    storage, and only a count and a checksum reach the driver. Minima are aggregated before the
    shuffle; the join of a star's many leaves with its one minimum may be split when skewed.
    """
    now = written(edges.filter("u <> v").distinct(), "links")
    state = _state(now)
    if not state[0]:
        return now
    for _ in range(limit):
        now = written(_small_star(_large_star(now)).filter("u <> v").distinct(), "links")
        last, state = state, _state(now)
        if state == last:
            return now
    raise RuntimeError(f"components did not settle in {limit} rounds")

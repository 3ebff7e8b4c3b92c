"""Data-quality checks. A check names violating rows; none means it passes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkelt.operators.upsert import orphans

ROW_CHECKS = ("not_null", "accepted_values", "dropoff_after_pickup", "positive", "positive_or_zero")


@dataclass(frozen=True)
class CheckSpec:
    """One check on one column (``column`` is empty for a whole-row check)."""

    model: str
    check: str
    column: str = ""
    values: tuple = ()
    to: str = ""
    field: str = ""


def violation(spec: CheckSpec) -> Column:
    """The predicate that is true on a violating row, for checks that look at one row at a time."""
    c = F.col(spec.column) if spec.column else None
    match spec.check:
        case "not_null":
            return c.isNull()
        case "accepted_values":
            return c.isNotNull() & ~c.isin(*spec.values)
        case "dropoff_after_pickup":
            return F.col("dropoff_datetime") <= F.col("pickup_datetime")
        case "positive":
            return c.isNull() | (c <= 0)
        case "positive_or_zero":
            return c.isNull() | (c < 0)
    raise ValueError(f"{spec.check!r} is not a row check")


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1")


def violations(spec: CheckSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The violating rows of one check (for ``unique``: the repeated values)."""
    df = tables[spec.model]
    if spec.check == "unique":
        return duplicates(df, spec.column)
    if spec.check == "relationships":
        return orphans(df, spec.column, tables[spec.to], spec.field)
    return df.filter(violation(spec))


# --- report -----------------------------------------------------------------------------------


def run_checks(tables: Mapping[str, DataFrame], specs: Iterable[CheckSpec]) -> DataFrame:
    """(model, column_name, check_name, failures) for every check.

    Per table: one aggregate pass for all row checks, one for all foreign keys together, and one
    grouping per unique column. ``failures`` counts rows; for ``unique`` it counts repeated values.
    """
    by_table: dict[str, list[CheckSpec]] = {}
    for s in specs:
        by_table.setdefault(s.model, []).append(s)
    parts = []
    for model, checks in by_table.items():
        df = tables[model]
        rows = [s for s in checks if s.check in ROW_CHECKS]
        keys = [s for s in checks if s.check == "relationships"]
        if rows:
            parts.append(_long(df.agg(*[_count(violation(s), i) for i, s in enumerate(rows)]), rows))
        if keys:
            parts.append(_relationships(df, keys, tables))
        for s in checks:
            if s.check == "unique":
                found = duplicates(df, s.column).agg(F.count(F.lit(1)).alias("_0"))
                parts.append(_long(found, [s]))
    return reduce(DataFrame.unionByName, parts)


def _count(hit: Column, i: int, weight: Column | None = None) -> Column:
    if weight is None:
        return F.count_if(hit).alias(f"_{i}")
    return F.coalesce(F.sum(F.when(hit, weight)), F.lit(0).cast("long")).alias(f"_{i}")


def _long(counts: DataFrame, specs: list[CheckSpec]) -> DataFrame:
    """One-row table of counters to one row per check."""
    rows = F.array(
        *[
            F.struct(
                F.lit(s.model).alias("model"),
                F.lit(s.column).alias("column_name"),
                F.lit(s.check).alias("check_name"),
                F.col(f"_{i}").alias("failures"),
            )
            for i, s in enumerate(specs)
        ]
    )
    return counts.select(F.inline(rows))


def _relationships(
    child: DataFrame, specs: list[CheckSpec], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Orphan rows of every foreign key from a single scan of the child.

    Values are counted before they meet the parents, so what is joined is the set of distinct
    (key, value) pairs, not the child's rows.
    """
    links = F.array(
        *[F.struct(F.lit(i).alias("_fk"), F.col(s.column).alias("_value")) for i, s in enumerate(specs)]
    )
    used = child.select(F.inline(links)).filter(F.col("_value").isNotNull())
    used = used.groupBy("_fk", "_value").agg(F.count(F.lit(1)).alias("_n"))
    parents = F.array(*[F.lit(s.to) for s in specs])
    used = used.withColumn("_to", parents[F.col("_fk")])
    targets = {s.to: s.field for s in specs}
    known = reduce(
        DataFrame.unionByName,
        [
            tables[t].select(F.lit(t).alias("_to"), F.col(f).alias("_value")).distinct()
            for t, f in targets.items()
        ],
    )
    # An outer join: an anti join would be moved below the counting, onto every row of the child.
    found = used.join(known.withColumn("_known", F.lit(True)), ["_to", "_value"], "left")
    lost = F.col("_known").isNull()
    counts = [_count(lost & (F.col("_fk") == i), i, F.col("_n")) for i in range(len(specs))]
    return _long(found.agg(*counts), specs)

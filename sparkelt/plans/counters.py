"""Check counters kept beside the tables: a run counts new units, and the report sums live ones.

Units are written once, so what was counted in one stays true. Row checks count a unit's failures,
foreign keys the uses of each value in a unit; the values meet the parents in the report, whichever
members came or went since. A repeated key lies in one partition, so ``unique`` keeps a number per
partition and the set of units that it was counted in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt.operators.quality import ROW_CHECKS, CheckSpec, duplicates, violation
from sparkelt.sources import storage
from sparkelt.sources.units import DAY_MILLIS, UnitLog
from sparkelt.sources.warehouse import NULL_PARTITION, SLICE, TableSpec, Warehouse

#: Counters of so many runs are put into one folder.
FOLD_RUNS = 20

COUNTERS = T.StructType(
    [
        T.StructField("unit", T.StringType()),
        T.StructField("check", T.IntegerType()),
        T.StructField("value", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
RUN = T.StructField("run", T.LongType())


def report(wh: Warehouse, tables: Mapping[str, TableSpec], specs: Iterable[CheckSpec]) -> DataFrame:
    """(model, column_name, check_name, failures) of every check, as ``run_checks`` has them.

    Only units and partitions that no earlier report has counted are read. Counters belong to the
    list of a table's checks; another list begins anew. A run that dies leaves a folder that
    no entry names; one run at a time is assumed, as for the tables.
    """
    by_table: dict[str, list[CheckSpec]] = {}
    for s in specs:
        by_table.setdefault(s.model, []).append(s)
    parts = [TableCounters(wh, tables[model], checks).report(tables) for model, checks in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


class TableCounters:
    """The counters of one table's checks, in ``_checks/<hash of the checks>`` below it."""

    def __init__(self, wh: Warehouse, table: TableSpec, specs: list[CheckSpec]):
        self.wh, self.table, self.specs = wh, table, specs
        label = hashlib.sha256(repr(specs).encode()).hexdigest()[:16]
        self.home = f"{wh.path(table.layer, table.name)}/_checks/{label}"
        self.rows = UnitLog(wh.spark, f"{self.home}/rows")
        self.keys = UnitLog(wh.spark, f"{self.home}/keys")

    def _of(self, *kinds: str) -> dict[int, CheckSpec]:
        return {i: s for i, s in enumerate(self.specs) if s.check in kinds}

    # --- row checks and foreign keys ----------------------------------------------------------

    def refresh(self) -> list[str]:
        """Count the live units that are not counted yet; returns them."""
        live, known = self.wh.live(self.table) or {}, self.rows.live() or {}
        fresh, gone = sorted(set(live) - set(known)), set(known) - set(live)
        if fresh:
            kept = {u: run for u, run in known.items() if u in live}
            fold = len(set(kept.values())) >= FOLD_RUNS
            counted = self.count(self.wh.read(self.table, units=fresh, placed=True))
            if fold:
                counted = counted.unionByName(self.stored(kept))
            run = max(storage.now_millis(), *(n + 1 for n in known.values()), 0)
            counted.write.mode("overwrite").parquet(f"{self.home}/rows/{RUN.name}={run}")
            self.rows.commit(dict.fromkeys([*fresh, *(kept if fold else ())], run), gone)
            self._tidy()
        elif gone:
            self.rows.commit({}, gone)
        return fresh

    def count(self, placed: DataFrame) -> DataFrame:
        """(unit, check, value, n) of rows with their partition and slice: at most a pass for the row
        checks and one for the foreign keys, combined before they move."""
        part = F.coalesce(F.col(self.table.part.name).cast("string"), F.lit(NULL_PARTITION))
        unit = F.concat(F.lit(f"{self.table.part.name}="), part, F.lit(f"/{SLICE.name}="), F.col(SLICE.name)).alias("unit")
        rows, links = self._of(*ROW_CHECKS), self._of("relationships")
        out = []
        if rows:
            found = placed.groupBy(unit).agg(*[F.count_if(violation(s)).alias(f"_{i}") for i, s in rows.items()])
            counts = [_struct(i, F.lit(None).cast("string"), F.col(f"_{i}")) for i in rows]
            out.append(found.select("unit", F.inline(F.array(*counts))).filter("n > 0"))
        if links:
            used = [_struct(i, F.col(s.column).cast("string"), F.lit(1).cast("long")) for i, s in links.items()]
            one = placed.select(unit, F.inline(F.array(*used))).filter("value IS NOT NULL")
            out.append(one.groupBy("unit", "check", "value").agg(F.sum("n").alias("n")))
        if not out:
            return self.wh.spark.createDataFrame([], COUNTERS)
        return reduce(DataFrame.unionByName, out)

    def stored(self, units: Mapping[str, int]) -> DataFrame:
        """The counters of some units, each from the run that it is counted in."""
        spark, base = self.wh.spark, f"{self.home}/rows"
        if not units:
            return spark.createDataFrame([], COUNTERS)
        places = [f"{base}/{RUN.name}={run}" for run in sorted(set(units.values()))]
        schema = T.StructType([*COUNTERS.fields, RUN])
        found = spark.read.schema(schema).option("basePath", base).parquet(*places)
        wanted = spark.createDataFrame(sorted(units.items()), T.StructType([COUNTERS["unit"], RUN]))
        return found.join(wanted, ["unit", RUN.name], "left_semi").select(*COUNTERS.names)

    def _tidy(self) -> None:
        """Counters that no entry names are of no use to readers after a day."""
        used = {f"{RUN.name}={run}" for run in (self.rows.live() or {}).values()}
        for name in storage.child_names(self.wh.spark, f"{self.home}/rows"):
            place = f"{self.home}/rows/{name}"
            old = name.startswith(f"{RUN.name}=") and name not in used
            if old and storage.modified_millis(self.wh.spark, place) < storage.now_millis() - DAY_MILLIS:
                storage.delete(self.wh.spark, place)

    # --- unique -------------------------------------------------------------------------------

    def repeated(self) -> dict[int, int]:
        """Check -> repeated values. Of the key only partitions whose units changed are read; another
        column's values may repeat across partitions, so that the whole column is."""
        out = {}
        wanted: dict[str, int] = {}
        known = self.keys.live() or {}
        for i, s in self._of("unique").items():
            if s.column != self.table.key:
                out[i] = duplicates(self.wh.read(self.table), s.column).count()
                continue
            wanted = self._by_partition(known)
            out[i] = sum(wanted.values())
        fresh = {name: n for name, n in wanted.items() if name not in known}
        gone = set(known) - set(wanted)
        if fresh or gone:
            self.keys.commit(fresh, gone)
        return out

    def _by_partition(self, known: Mapping[str, int]) -> dict[str, int]:
        """Repeated keys of each partition, by its folder and a hash of its units."""
        units: dict[str, list[str]] = {}
        for unit in sorted(self.wh.live(self.table) or ()):
            units.setdefault(unit.split("/")[0], []).append(unit)
        names = {p: f"{p}/{hashlib.sha256(' '.join(us).encode()).hexdigest()[:32]}" for p, us in units.items()}
        fresh = [p for p, name in names.items() if name not in known]
        counted = dict.fromkeys(fresh, 0)
        if fresh:
            part, key = self.table.part.name, self.table.key
            rows = self.wh.read(self.table, units=[u for p in fresh for u in units[p]], placed=True)
            repeated = rows.filter(F.col(key).isNotNull()).groupBy(part, key).count().filter("count > 1")
            told = repeated.groupBy(F.col(part).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
            for r in told.collect():  # one row per partition that has repeated keys
                counted[f"{part}={NULL_PARTITION if r.p is None else r.p}"] = r.n
        return {name: counted[p] if p in counted else known[name] for p, name in names.items()}

    # --- report -------------------------------------------------------------------------------

    def report(self, tables: Mapping[str, TableSpec]) -> DataFrame:
        """Failures of every check, after a refresh."""
        self.refresh()
        repeated = self.repeated()
        spark, links = self.wh.spark, self._of("relationships")
        sums = self.stored(self.rows.live() or {}).groupBy("check", "value").agg(F.sum("n").alias("n"))
        if links:
            to = F.array(*[F.lit(s.to if s.check == "relationships" else None) for s in self.specs])
            parents = {s.to: s.field for s in links.values()}
            known = [
                self.wh.read(tables[t]).select(F.lit(t).alias("to"), F.col(f).cast("string").alias("value")).distinct()
                for t, f in parents.items()
            ]
            known = reduce(DataFrame.unionByName, known).withColumn("known", F.lit(True))
            sums = sums.withColumn("to", to[F.col("check")]).join(known, ["to", "value"], "left").filter("known IS NULL")
        failures = sums.groupBy("check").agg(F.sum("n").alias("n"))
        told = [(i, s.model, s.column, s.check, repeated.get(i, 0)) for i, s in enumerate(self.specs)]
        every = spark.createDataFrame(told, "check int, model string, column_name string, check_name string, m long")
        return every.join(failures, "check", "left").select(
            "model", "column_name", "check_name", (F.col("m") + F.coalesce("n", F.lit(0))).alias("failures")
        )


def _struct(check: int, value: Column, n: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), value.alias("value"), n.cast("long").alias("n"))

"""Check counters by unit: always what a count of all rows gives, from reading new units only."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt import schemas as S
from sparkelt.fixtures import first_batch, raw_feed
from sparkelt.operators.quality import CheckSpec, run_checks
from sparkelt.plans import counters
from sparkelt.plans import pipeline as P
from sparkelt.sources import storage, units
from sparkelt.sources.warehouse import TableSpec, Warehouse

DAY = T.StructField("day", T.DateType())


def schema(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def day_of():
    return F.to_date("at")


CHILD = TableSpec(
    "mart",
    "child",
    schema(
        id=T.StringType(),
        at=T.TimestampNTZType(),
        amount=T.DoubleType(),
        kind=T.IntegerType(),
        parent=T.IntegerType(),
        other=T.StringType(),
    ),
    "id",
    DAY,
    day_of,
)
PARENT = TableSpec("mart", "parent", schema(id=T.LongType(), at=T.TimestampNTZType()), "id", DAY, day_of)
TABLES = {"child": CHILD, "parent": PARENT}
SPECS = [
    CheckSpec("child", "positive", "amount"),
    CheckSpec("child", "not_null", "at"),
    CheckSpec("child", "unique", "id"),
    CheckSpec("child", "accepted_values", "kind", (1, 2)),
    CheckSpec("child", "relationships", "parent", to="parent", field="id"),
    CheckSpec("child", "unique", "other"),
    CheckSpec("parent", "unique", "id"),
]


def put(wh, table, rows, replaced=(), **kw):
    df = wh.spark.createDataFrame(rows, table.schema).coalesce(1)
    return wh.write(table, table.with_part(df), replaced, **kw)


def child(i, day=1, amount=1.0, kind=1, parent=1, other=None):
    return (i, None if day is None else datetime(2024, 1, day, 9), amount, kind, parent, other)


def parents(wh, *ids):
    return put(wh, PARENT, [(i, datetime(2024, 1, 1)) for i in ids])


def told(df):
    rows = [(r.model, r.column_name, r.check_name, r.failures) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return sorted(rows)


def agreed(wh, specs=SPECS):
    """The report, after it was compared with a count of all rows."""
    found = told(counters.report(wh, TABLES, specs))
    assert found == told(run_checks({name: wh.read(t) for name, t in TABLES.items()}, specs))
    return {(c, k): n for m, c, k, n in found if m == "child"}


@pytest.fixture
def read(monkeypatch):
    """The units that are read with their partitions, which counting does."""
    out, real = [], Warehouse.read

    def spy(self, table, partitions=None, units=None, placed=False):
        if placed and table is CHILD:
            out.append(set(units))
        return real(self, table, partitions, units, placed)

    monkeypatch.setattr(Warehouse, "read", spy)
    return out


def test_units_come_and_go(spark, warehouse, read):
    parents(warehouse, 1)
    a = put(warehouse, CHILD, [child("a"), child("b", amount=0.0, kind=3, parent=9), child("c", 2, None, None, None)])
    got = agreed(warehouse)
    assert got["amount", "positive"] == 2 and got["kind", "accepted_values"] == 1 and got["parent", "relationships"] == 1
    assert read == [set(a)] * 2  # the row checks and links in one read, keys in another
    read.clear()
    assert agreed(warehouse) == got and read == []

    b = put(warehouse, CHILD, [child("d", 2, -1.0), child("e", 3, parent=9)])
    got = agreed(warehouse)
    assert got["amount", "positive"] == 3 and got["parent", "relationships"] == 2
    second = {u for u in [*a, *b] if not u.startswith("day=2024-01-01")}
    assert read == [set(b), second]  # rows of the new units; keys of the dates that they belong to
    read.clear()

    gone = [u for u in a if u.startswith("day=2024-01-01")]
    c = put(warehouse, CHILD, [child("a"), child("b")], gone)
    got = agreed(warehouse)
    assert got["amount", "positive"] == 2 and got["parent", "relationships"] == 1
    assert read == [set(c), set(c)]
    put(warehouse, CHILD, [], c)
    assert agreed(warehouse)["amount", "positive"] == 2


def test_members_may_come_later(warehouse, read):
    parents(warehouse, 1)
    put(warehouse, CHILD, [child("a", parent=2), child("b", parent=2), child("c", parent=3)])
    assert agreed(warehouse)["parent", "relationships"] == 3
    read.clear()
    parents(warehouse, 2)
    assert agreed(warehouse)["parent", "relationships"] == 1 and read == []


def test_repeated_keys(warehouse):
    parents(warehouse, 1)
    put(warehouse, CHILD, [child("a"), child("a"), child(None), child(None), child("n", None), child("n", None)])
    assert agreed(warehouse)["id", "unique"] == 2
    put(warehouse, CHILD, [child("b", other="x"), child("c", 2, other="x"), child("n", None)])
    got = agreed(warehouse)
    assert got["id", "unique"] == 2 and got["other", "unique"] == 1 and got["at", "not_null"] == 3
    put(warehouse, CHILD, [child("b"), child("c", 2, other="y")])
    assert agreed(warehouse)["id", "unique"] == 4


def test_empty_tables_and_a_fresh_start(warehouse):
    assert set(agreed(warehouse).values()) == {0}
    put(warehouse, CHILD, [child("a", amount=0.0)], replaced=None)
    assert agreed(warehouse)["amount", "positive"] == 1
    put(warehouse, CHILD, [child("b"), child("b")], replaced=None)
    got = agreed(warehouse)
    assert got["amount", "positive"] == 0 and got["id", "unique"] == 1


def test_other_checks_are_counted_anew(warehouse, read):
    parents(warehouse, 1)
    a = put(warehouse, CHILD, [child("a", kind=3), child("b", kind=4)])
    assert agreed(warehouse)["kind", "accepted_values"] == 2
    read.clear()
    wider = [CheckSpec("child", "accepted_values", "kind", (1, 2, 3)), CheckSpec("child", "positive_or_zero", "amount")]
    assert agreed(warehouse, wider)["kind", "accepted_values"] == 1 and read == [set(a)]


def test_a_report_that_dies_is_made_up_for(warehouse, monkeypatch):
    parents(warehouse, 1)
    put(warehouse, CHILD, [child("a", amount=0.0), child("b"), child("b")])
    real, left = units.UnitLog.commit, [0]

    def dies(self, *args, **kw):
        left[0] += 1
        if left[0] == fails:
            raise RuntimeError("lost")
        return real(self, *args, **kw)

    for fails in (1, 2):
        left[0] = 0
        with monkeypatch.context() as m:
            m.setattr(units.UnitLog, "commit", dies)
            with pytest.raises(RuntimeError):
                counters.report(warehouse, TABLES, SPECS)
    got = agreed(warehouse)
    assert got["amount", "positive"] == 1 and got["id", "unique"] == 1


def test_runs_are_folded(spark, warehouse, monkeypatch):
    monkeypatch.setattr(counters, "FOLD_RUNS", 3)
    parents(warehouse, 1)
    own = counters.TableCounters(warehouse, CHILD, [s for s in SPECS if s.model == "child"])
    written = []
    for n in range(8):
        gone = written[:1] if n == 5 else []
        written += put(warehouse, CHILD, [child(f"k{n}", n + 1, 0.0, parent=n)], gone)
        assert own.refresh() == written[-1:]
        assert len(set(own.rows.live().values())) <= 3
    assert agreed(warehouse)["amount", "positive"] == 7
    kept = set(own.rows.live().values())
    monkeypatch.setattr(counters, "DAY_MILLIS", -1000)  # so that folders of before are old
    put(warehouse, CHILD, [child("z", 9, 0.0)])
    assert agreed(warehouse)["amount", "positive"] == 8
    left = {n for n in storage.child_names(spark, f"{own.home}/rows") if n.startswith("run=")}
    assert left == {f"run={r}" for r in own.rows.live().values()} and len(left) <= len(kept) + 1


def test_all_models_after_two_batches(spark, warehouse, sf_dir, monkeypatch):
    """Reports equal those of all rows; the second reads what the second run wrote."""
    raw = {f.name: raw_feed(spark, sf_dir, f) for f in S.FEEDS.values()}
    everything = {name: m.table for name, m in P.MODELS.items()}
    fresh = {}
    real = counters.TableCounters.refresh

    def spy(self):
        fresh[self.table.name] = real(self)
        return fresh[self.table.name]

    monkeypatch.setattr(counters.TableCounters, "refresh", spy)
    before = {}
    for batch in ({n: first_batch(df) for n, df in raw.items()}, raw):
        report = P.run_pipeline(warehouse, batch)
        assert told(report) == told(run_checks(P.tables(warehouse), P.CHECKS))
        for name in fresh:
            live = set(warehouse.live(everything[name]))
            assert set(fresh[name]) == live - before.get(name, set())
            before[name] = live
    assert P.check_report(warehouse).count() == len(P.CHECKS) and not any(fresh.values())
    late = datetime(2024, 2, 1) + timedelta(days=30)
    one = raw["green"].limit(1).withColumn("loaded_at", F.lit(late).cast("timestamp_ntz")).withColumn("fare_amount", F.lit(5.0))
    P.run_models(warehouse, {"green": one.select(*raw["green"].columns), "yellow": raw["yellow"].limit(0)})
    assert told(P.check_report(warehouse)) == told(run_checks(P.tables(warehouse), P.CHECKS))
    assert len(fresh["stg_green_taxi"]) < len(before["stg_green_taxi"]) and fresh["stg_yellow_taxi"] == []

"""Incremental runs: read what is new, transform it, upsert it by key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkelt.functions.columns import packed_key, unpacked_key
from sparkelt.operators.filters import since, since_marks
from sparkelt.schemas import FEED_NAMES
from sparkelt.sources.warehouse import MarkDict, TableSpec, Warehouse


def _same(df: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return df


#: Rows of a partition that meet in one task to be settled, and how often a key occurs there that is
#: settled beforehand.
TASK_ROWS = 500_000
HOT_ROWS = 100_000
#: Units of less than so many bytes are gathered with the new rows that they are merged with.
TINY_BYTES = 1 << 20
#: The rows of so many units that a merge replaces are counted, so that those that it writes are not too many.
MANY_UNITS = 256
#: The place of a row while it is settled.
PLACE = ("_place_part", "_place_block")


@dataclass(frozen=True)
class Model:
    """A stored model and how to compute it.

    ``inputs`` names the upstream frames in the order ``build`` takes them, each with the feed it
    holds, or None if it holds both and tells them apart by ``taxi_type``. The rows come about in
    three steps: ``build`` is cheap and may yield several versions of a key, ``settle`` leaves one,
    ``finish`` adds columns that are best computed after the rows have moved to their place.
    """

    table: TableSpec
    inputs: Mapping[str, str | None]
    build: Callable[..., DataFrame]
    settle: Callable[..., DataFrame] = _same  # takes columns that all versions of a key share as well
    finish: Callable[[DataFrame], DataFrame] = _same
    spread: bool = False  # regroup rows by partition before a write; else they lie by partition in the inputs
    rowwise: bool = False  # maps each row of its one input to one of its own, units and all
    group: str = ""  # models of a group run together, from one pass over their input

    @property
    def name(self) -> str:
        return self.table.name

    @property
    def feeds(self) -> tuple[str, ...]:
        named = tuple(f for f in self.inputs.values() if f is not None)
        return named or FEED_NAMES


@dataclass(frozen=True)
class RunResult:
    """What a run did. ``touched`` lists the partitions its rows fell into, as text, and ``added`` the
    units it wrote; None: all of a build."""

    model: str
    kind: str  # "full", "merge" or "none"
    touched: list[str | None] | None
    before: MarkDict
    after: MarkDict
    added: list[str] | None = None


def watermark(df: DataFrame) -> datetime | None:
    """Greatest load time; None for an empty table."""
    return df.agg(F.max("loaded_at")).first()[0]


def watermarks(df: DataFrame, feeds: tuple[str, ...]) -> MarkDict:
    """Greatest load time per feed of rows that hold one feed, or tell them apart."""
    if len(feeds) == 1:
        return {feeds[0]: watermark(df)}
    found = df.groupBy("taxi_type").agg(F.max("loaded_at"))
    rows = found.filter(F.col("taxi_type").isin(*feeds)).collect()  # one row per feed
    return dict.fromkeys(feeds) | {r[0]: r[1] for r in rows}


def current_marks(wh: Warehouse, model: Model) -> MarkDict | None:
    """The marks of the last run; None when the model has to be built from all input.

    Without stored marks a table is built again: its own rows cannot tell how far each feed had got,
    and the later feed's maximum would hide rows of the slower one. An existing but empty table
    counts as not built, so its NULL marks cannot block it for good.
    """
    marks = wh.marks(model.table) if wh.exists(model.table) else None
    return None if marks is None or all(m is None for m in marks.values()) else marks


def run_model(
    wh: Warehouse,
    model: Model,
    inputs: Mapping[str, DataFrame],
    upstream: MarkDict | None = None,
    full_refresh: bool = False,
) -> RunResult:
    """First run: everything. Later runs: rows loaded after the marks, merged by key.

    ``upstream`` gives the marks up to which the inputs are complete; without it the new marks are
    measured on the model's own rows or, if those do not tell the feeds apart, on its inputs.
    """
    before = None if full_refresh else current_marks(wh, model)
    fresh = []
    for name, feed in model.inputs.items():
        df = inputs[name]
        if before is not None:
            df = since_marks(df, before) if feed is None else since(df, before.get(feed))
        fresh.append(df)
    if upstream is None and len(model.feeds) > 1 and "taxi_type" not in model.table.schema.names:
        upstream = dict.fromkeys(model.feeds)
        for df, feed in zip(fresh, model.inputs.values()):
            upstream = _later(upstream, watermarks(df, model.feeds if feed is None else (feed,)))
    return apply_updates(wh, model, model.build(*fresh), before, upstream)


def apply_updates(
    wh: Warehouse,
    model: Model,
    rows: DataFrame,
    before: MarkDict | None,
    upstream: MarkDict | None = None,
) -> RunResult:
    """Store a model's new rows (as ``build`` made them), then its marks."""
    if before is None:
        return _build(wh, model, rows, upstream)
    # What a merge must know in advance, the partitions and the keys, takes a few columns of the
    # unsettled rows. Reading those again is cheaper than keeping the wide rows around.
    table = model.table
    found = _survey(model, rows)
    touched, after = list(found.rows), _later(before, upstream or found.marks)
    if touched == []:
        if after != before:
            wh.set_marks(table, after)
        return RunResult(model.name, "none", [], before, after, [])
    part = table.part_of().alias(table.part.name)
    near = wh.units_in(table, touched)
    crowded = wh.crowded(table, near)
    keys = rows.select(table.key, part)
    matched = set(wh.matched_units(table, near, keys)) if near else set()
    updates = model.finish(_settled(model, rows, found) if model.settle is not _same else rows)
    placed = updates.select(*table.schema.names).transform(table.with_part)
    folded = crowded | {u for u in matched if near[u] < min(TINY_BYTES, wh.small_bytes)}
    count = sum(found.rows.values())
    if folded:
        kept = wh.without(table, folded, keys).transform(table.with_part)
        # New rows that fill units by themselves need not move for the sake of a few old ones.
        if count < len(touched) * (wh.unit_rows // 2):
            placed = _gather(placed.unionByName(kept), table)
        else:
            placed = placed.unionByName(_gather(kept, table))
    # Old rows of other units lie by partition as they are.
    if whole := matched - folded:
        placed = placed.unionByName(wh.without(table, whole, keys).transform(table.with_part))
    replaced = matched | crowded
    if len(replaced) > MANY_UNITS:
        count += wh.key_hashes(table, replaced).count()
    added = wh.write(table, placed, replaced, None, count)
    wh.set_marks(table, after)
    return RunResult(model.name, "merge", touched, before, after, added)


def mirror(
    wh: Warehouse, model: Model, upstream: Model, done: RunResult, before: MarkDict | None
) -> RunResult:
    """Follow an upstream table unit by unit.

    For models that map each upstream row to one of their own with the same key and partition. Each
    upstream unit has one of the same name here, so what differs between the two lists of units is
    what has to be done: no join, shuffle or survey, and whatever an earlier run left undone is made
    up for. Without marks all units are made anew.
    """
    table, after = model.table, _later(before or {}, done.after)
    wanted = set(wh.live(upstream.table) or ())
    own = set(wh.live(table) or ())
    missing = sorted(wanted if before is None else wanted - own)
    gone = own - wanted
    kind = "full" if before is None else "merge" if missing or gone else "none"
    if before is None:
        wh.clear_marks(table)
    if kind != "none":
        rows = model.build(wh.read(upstream.table, units=missing, placed=True))
        wh.write(table, rows.transform(table.with_part), None if before is None else gone, missing)
    if after != before:
        wh.set_marks(table, after)
    if before is None:
        return RunResult(model.name, kind, None, dict.fromkeys(model.feeds), after)
    touched = list(dict.fromkeys(table.part_text(u) for u in missing))
    return RunResult(model.name, kind, touched, before, after, missing)


def _build(wh: Warehouse, model: Model, rows: DataFrame, upstream: MarkDict | None) -> RunResult:
    table = model.table
    wh.clear_marks(table)
    # Regroup the narrow rows first; what finish() adds is never shuffled.
    found = None
    if model.settle is not _same:
        found = _survey(model, rows)
        rows = _settled(model, rows, found)
    elif model.spread:
        part = table.part_of().alias(table.part.name)
        rows = _gather(rows.select("*", part), table).drop(table.part.name)
    wh.write(table, model.finish(rows).transform(table.with_part), None, None, sum(found.rows.values()) if found else 0)
    # The newest version of a key is the last loaded, so settled rows have the marks of all.
    after = upstream or (found.marks if found else watermarks(wh.read(table), model.feeds))
    wh.set_marks(table, after)
    return RunResult(model.name, "full", None, dict.fromkeys(model.feeds), after)


def _gather(df: DataFrame, table: TableSpec) -> DataFrame:
    """Bring rows of a partition together for writing. A rebalance is splittable: a partition with
    a third of all rows is spread over many tasks, small ones share a task."""
    return df.hint("rebalance", table.part.name)


def _settled(model: Model, rows: DataFrame, found: Survey) -> DataFrame:
    """One version of each key, those of a partition together: a single shuffle does both.

    Partitions are cut into blocks by key, none of which is more than a task settles. Versions of a
    key that alone would fill a block are settled before, where every task sends one at most.
    """
    table = model.table
    day = table.part_of().cast("string")
    if found.hot:
        often = F.xxhash64(table.key).isin(*found.hot)
        rows = rows.filter(~often).unionByName(model.settle(rows.filter(often)))
    most = max(found.rows.values(), default=0)
    large = [p for p, n in found.rows.items() if n > TASK_ROWS]
    place = {PLACE[0]: day}
    if large:
        wide = reduce(or_, [day.isin(*[p for p in large if p is not None]), *([day.isNull()] if None in large else [])])
        block = F.expr(f"pmod(xxhash64({table.key}), {-(-most // TASK_ROWS)})")
        place[PLACE[1]] = F.when(wide, block).otherwise(0)
    half = dict(zip(("_key_bytes", "_key_text"), packed_key(table.key)))
    placed = rows.withColumns(place | half).drop(table.key).repartition(*place)
    placed = placed.withColumn(table.key, unpacked_key(*half)).select(*rows.columns, *place)
    return model.settle(placed, list(place)).drop(*place)


@dataclass(frozen=True)
class Survey:
    """What is known of rows before they move: rows by partition, marks, and hashes of hot keys."""

    rows: dict[str | None, int]
    marks: MarkDict
    hot: list[int]


def _survey(model: Model, rows: DataFrame) -> Survey:
    """Partitions the rows fall into and the rows' own marks, in one job.

    The driver gets a row per partition and feed, no more than the folders that it lists to read the
    table at all. Partition values come as text, the way folders are named, since Spark's dates
    reach further than Python's.
    """
    by = [model.table.part_of().cast("string").alias("_part")]
    if "taxi_type" in rows.columns:
        by.append(F.col("taxi_type"))
    told = [F.max("loaded_at").alias("loaded_at"), F.count(F.lit(1)).alias("n")]
    if model.settle is not _same:
        told.append(F.expr(f"approx_top_k(xxhash64({model.table.key}), 8, 1024)").alias("top"))
    found = rows.groupBy(*by).agg(*told).collect()
    marks: MarkDict = dict.fromkeys(model.feeds)
    counts: dict[str | None, int] = {}
    hot: set[int] = set()
    for row in found:
        counts[row["_part"]] = counts.get(row["_part"], 0) + row["n"]
        if model.settle is not _same:
            hot |= {t["item"] for t in row["top"] if t["count"] >= HOT_ROWS}
        for feed in [row["taxi_type"]] if len(by) > 1 else model.feeds:
            marks = _later(marks, {feed: row["loaded_at"]})
    return Survey(counts, marks, sorted(hot))


def _later(before: MarkDict, new: MarkDict) -> MarkDict:
    def pick(feed: str) -> datetime | None:
        known = [m for m in (before.get(feed), new.get(feed)) if m is not None]
        return max(known, default=None)

    return {feed: pick(feed) for feed in before | new}

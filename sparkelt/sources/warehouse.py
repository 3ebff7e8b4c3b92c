"""Tables as partitioned parquet under one root: ``root/<layer>/<table>``."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt.operators import upsert
from sparkelt.operators.upsert import WORD_BITS
from sparkelt.schemas import FEEDS, FeedSpec
from sparkelt.sources import batches, storage
from sparkelt.sources.units import UnitLog

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
DEFAULT_LAYER = "raw"
RAW_PARTITIONS = (
    T.StructField("load_date", T.DateType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
)

SLICE = T.StructField("slice", T.StringType())
#: Rows that one task puts into a unit, which a merge rewrites as a whole.
UNIT_ROWS = 1_000_000
#: So many units of a task have half that size; the next ones hold 1, 3, 5, ... times as many rows, so that
#: the number of units, folders that the driver lists, grows slower than the rows.
FULL_UNITS = 512
#: Of a write that would make more units than that, units grow as the square root of what it would make, and
#: only those of so many bytes have an index: for less, a folder costs more than reading the keys does.
INDEXED_BYTES = 4 << 20
#: Tasks that list folders, at least, and folders that each lists beyond that.
LISTING_TASKS, LISTED = 64, 64
#: A merge also rewrites the small units of a partition once there are so many; together they make a unit of
#: less than so many bytes.
SMALL_UNITS = 8
SMALL_BYTES = 32 << 20
#: The most words of 4 KB that a merge sends to its scan (64 MB), and the least bytes that a row takes on disk.
BITMAP_WORDS = 1 << 14
LEAST_ROW_BYTES = 16
#: Keys are hashes in hex, which only an entropy coder halves.
CODEC = "zstd"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

MarkDict = dict[str, datetime | None]


def layer_name(layer: str | None) -> str:
    """The layer a model goes to: its own name, trimmed, or the default one."""
    return DEFAULT_LAYER if layer is None else layer.strip()


def qualified_name(layer: str | None, model: str) -> str:
    return f"{layer_name(layer)}.{model}"


@dataclass(frozen=True)
class TableSpec:
    """A stored model: its columns, key, and physical layout.

    ``part`` is a column that exists on disk only. It must be a function of the key, so that an
    upsert can find the old version of a row in the same partition as the new one. ``indexed``
    tables keep the hashes of their keys by unit, so that a merge finds matched units without
    reading the keys themselves.
    """

    layer: str
    name: str
    schema: T.StructType
    key: str
    part: T.StructField
    part_of: Callable[[], Column]
    sort: Callable[[], list[Column]] | None = None
    indexed: bool = False

    @property
    def full_name(self) -> str:
        return qualified_name(self.layer, self.name)

    def with_part(self, df: DataFrame) -> DataFrame:
        """The declared columns and the partition's, and a given ``slice``."""
        own = [SLICE.name] if SLICE.name in df.columns else []
        return df.select(*self.schema.names, self.part_of().alias(self.part.name), *own)

    def part_text(self, unit: str) -> str | None:
        """The partition value of a unit, as its folder has it."""
        value = unit.split("/")[0].removeprefix(f"{self.part.name}=")
        return None if value == NULL_PARTITION else value


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        unit_rows: int = UNIT_ROWS,
        small_bytes: int = SMALL_BYTES,
        keep_replaced: bool = True,
    ):
        """``keep_replaced=False`` deletes replaced units once a write is committed: for a warehouse without
        other readers, whose own frames over a table are not used past the table's next write."""
        self.spark, self.root = spark, root.rstrip("/")
        self.unit_rows, self.small_bytes, self.keep_replaced = unit_rows, small_bytes, keep_replaced

    def within(self, spark: SparkSession) -> Warehouse:
        """The same warehouse in another session."""
        return Warehouse(spark, self.root, self.unit_rows, self.small_bytes, self.keep_replaced)

    # --- places -------------------------------------------------------------------------------

    def path(self, layer: str | None, name: str) -> str:
        return f"{self.root}/{layer_name(layer)}/{name}"

    def exists(self, table: TableSpec) -> bool:
        """True once a write of the table has been committed; folders alone do not make a table."""
        return self.live(table) is not None

    # --- raw layer ----------------------------------------------------------------------------

    def raw_path(self, feed: FeedSpec) -> str:
        return self.path("raw", feed.raw_name)

    def dead_letter_path(self, feed: FeedSpec) -> str:
        return f"{self.raw_path(feed)}_dead_letters"

    def source(self, name: str, newer_than: datetime | None = None) -> DataFrame:
        """A declared source table by name, e.g. ``green_taxi``."""
        feeds = {f.raw_name: f for f in FEEDS.values()}
        return self.read_raw(feeds[name], newer_than)

    def read_raw(self, feed: FeedSpec, newer_than: datetime | None = None) -> DataFrame:
        """Raw rows of a feed; only batches that hold newer rows are listed and read.

        The manifest says which. A table without one is read by load date.
        """
        path, physical = self.raw_path(feed), T.StructType([*feed.raw_schema.fields, *RAW_PARTITIONS])
        if batches.has_manifest(self.spark, path):
            mark = None if newer_than is None else batches.micros(newer_than)
            live = batches.live_batches(self.spark, path)
            chosen = [b.folder for b in live if mark is None or b.greatest > mark]
        else:
            chosen = [n for n in storage.child_names(self.spark, path) if n.startswith("load_date=")]
            if newer_than is not None:
                chosen = [n for n in chosen if n >= f"load_date={newer_than.date().isoformat()}"]
        return self._scan(path, chosen, physical).select(*feed.raw_schema.names)

    def compact_raw(self, feed: FeedSpec, target_bytes: int = batches.TARGET_BYTES) -> int:
        """Small batches of a feed into large files; returns how many folders were made.

        The last batch of each streaming query may be replayed and is left as it is.
        """
        path = self.raw_path(feed)
        notes = [n.split("@")[0] for n in storage.child_names(self.spark, f"{path}/_loads") if "@" in n]
        pending = [(n.rpartition(".")[0], int(n.rpartition(".")[2])) for n in notes if not n.startswith(".")]
        return len(batches.compact(self.spark, path, feed.raw_schema, pending, target_bytes))

    def vacuum_raw(self, feed: FeedSpec, keep: timedelta = timedelta(days=1)) -> list[str]:
        return batches.vacuum(self.spark, self.raw_path(feed), keep)

    # --- model tables -------------------------------------------------------------------------

    def live(self, table: TableSpec) -> dict[str, int] | None:
        """Live units and their bytes; None if the table was never written."""
        return UnitLog(self.spark, self.path(table.layer, table.name)).live()

    def units_in(self, table: TableSpec, partitions: Iterable[str | None]) -> dict[str, int]:
        """Live units of the given partitions (as text)."""
        wanted = set(partitions)
        return {u: n for u, n in (self.live(table) or {}).items() if table.part_text(u) in wanted}

    def read(
        self,
        table: TableSpec,
        partitions: Iterable[str | None] | None = None,
        units: Iterable[str] | None = None,
        placed: bool = False,
    ) -> DataFrame:
        """The table's declared columns, optionally of some partitions or units only.

        ``placed`` adds the partition column and the slice.
        """
        if units is None:
            units = (self.live(table) or {}) if partitions is None else self.units_in(table, partitions)
        physical = T.StructType([*table.schema.fields, table.part, SLICE])
        found = self._scan(self.path(table.layer, table.name), list(units), physical)
        return found.select(*(physical.names if placed else table.schema.names))

    def _scan(self, base: str, chosen: list[str], schema: T.StructType) -> DataFrame:
        """Some of the folders under ``base``; only those are listed."""
        if not chosen:
            return self.spark.createDataFrame([], schema)
        # Spark lists each folder in a task of its own, up to this many.
        self.spark.conf.set(LISTING, str(max(LISTING_TASKS, len(chosen) // LISTED)))
        reader = self.spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{n}" for n in chosen])

    def key_hashes(self, table: TableSpec, units: Iterable[str]) -> DataFrame:
        """Partition, slice and the key's hash of every row of some units: the index, where there is one."""
        units, index = list(units), f"{self.path(table.layer, table.name)}/_index"
        known = self._folders(index, table) if table.indexed else set()
        plain = [u for u in units if u not in known]
        hashed = F.xxhash64(table.key).alias("h")
        rows = self.read(table, units=plain, placed=True).select(hashed, table.part.name, SLICE.name)
        if len(plain) == len(units):
            return rows
        schema = T.StructType([T.StructField("h", T.LongType()), table.part, SLICE])
        told = self._scan(index, [u for u in units if u in known], schema)
        return told.unionByName(rows) if plain else told

    def _folders(self, base: str, table: TableSpec, label: str = "") -> set[str]:
        """Units that have a folder under ``base``, of one write or of all."""
        found = storage.matching(self.spark, f"{base}/{table.part.name}=*/{SLICE.name}={label}*")
        return {"/".join(p.rstrip("/").split("/")[-2:]) for p in found}

    def crowded(self, table: TableSpec, units: dict[str, int]) -> set[str]:
        """Small units of partitions that have many of them; a merge takes them along.

        A unit that is full, or fills an eighth of ``small_bytes``, stays: taking it along costs more than its
        folder does.
        """
        small: dict[str | None, list[str]] = {}
        for unit, size in units.items():
            if size < self.small_bytes // SMALL_UNITS:
                small.setdefault(table.part_text(unit), []).append(unit)
        return {u for group in small.values() if len(group) >= SMALL_UNITS for u in group}

    def matched_units(self, table: TableSpec, units: Iterable[str], keys: DataFrame) -> list[str]:
        """Those of the units that hold one of the keys; ``keys`` has the key and the partition column.

        Equal hashes of different keys only make a unit be rewritten in vain.
        """
        part = table.part.name
        wanted = keys.select(part, F.xxhash64(table.key).alias("h")).distinct()  # combined on the map side
        found = self.key_hashes(table, units).join(wanted, [part, "h"], "left_semi").select(part, SLICE.name).distinct()
        rows = found.select(F.col(part).cast("string").alias("part"), SLICE.name).collect()  # one row per unit
        return [f"{part}={NULL_PARTITION if r.part is None else r.part}/{SLICE.name}={r.slice}" for r in rows]

    def without(self, table: TableSpec, units: Iterable[str], keys: DataFrame) -> DataFrame:
        """The rows of some units whose key is none of ``keys``, in the order and place that they have.

        Only hashes of the keys are shuffled: they tell the positions of the rows that go, which are
        sent to the scan as a bitmap of 4 KB per 32,768 rows. Keys are equal if 96 bits of two hashes
        are. Units that may take more than ``BITMAP_WORDS`` words go by a join of the rows with the keys.
        """
        units = list(units)
        sizes = self.live(table) or {}
        if len(units) + sum(sizes[u] for u in units) // (LEAST_ROW_BYTES * WORD_BITS) > BITMAP_WORDS:
            return upsert.without_keys(self.read(table, units=units), keys, table.key)
        part = F.coalesce(F.col(table.part.name).cast("string"), F.lit("")).alias("_part")
        word, hashed = F.shiftright("_at", 15).alias("_word"), [F.xxhash64(table.key).alias("_h"), F.hash(table.key).alias("_g")]
        physical = T.StructType([*table.schema.fields, table.part, SLICE])
        rows = self._scan(self.path(table.layer, table.name), units, physical)
        rows = rows.select(*physical.names, F.col("_metadata.row_index").alias("_at"))
        known = F.col(table.key).isNotNull()
        own = rows.filter(known).select(part, SLICE.name, "_at", *hashed)
        gone = own.join(keys.filter(known).select(*hashed).distinct(), ["_h", "_g"], "left_semi")
        bit = F.col("_at").bitwiseAND(F.lit(WORD_BITS - 1))
        words = gone.groupBy("_part", SLICE.name, word).agg(F.bitmap_construct_agg(bit).alias("_bits"))
        placed = rows.select(*table.schema.names, part, SLICE.name, "_at", word)
        marked = placed.join(F.broadcast(words), ["_part", SLICE.name, "_word"], "left")
        return marked.filter(~upsert.bit_set(F.col("_bits"), F.col("_at"))).select(*table.schema.names)

    def write(
        self,
        table: TableSpec,
        df: DataFrame,
        replaced: Iterable[str] | None,
        units: Iterable[str] | None = None,
        rows: int = 0,
    ) -> list[str]:
        """Add the rows (declared columns and partition) in new units and drop the replaced ones.

        None replaces all units. Rows get a slice by task, and by every half of ``unit_rows`` (of a
        long task by growing numbers), unless they bring one, in which case ``units`` are those that they make up.
        ``rows``, about how many there are, makes units larger where they would be very many. The commit is one
        log entry at the end: the frame may be computed from the units it replaces, lost tasks
        rerun, and a run that dies changes nothing. Returns the units written.
        """
        replaced = None if replaced is None else list(replaced)
        base, part = self.path(table.layer, table.name), table.part.name
        label = uuid.uuid4().hex[:12]
        if units is None:
            numbered = df.withColumn("_place", F.monotonically_increasing_id())
            task = F.shiftright("_place", 33).cast("string")
            # Rows come by partition, so that a unit fills up within one; at half the size a late row costs less.
            full = F.expr(f"(_place & {(1 << 33) - 1}) div {self._chunk(rows)}")
            later = FULL_UNITS + F.floor(F.sqrt(full - FULL_UNITS))
            chunk = F.when(full < FULL_UNITS, full).otherwise(later).cast("string")
            named = F.concat_ws("-", F.lit(label), task, chunk).alias(SLICE.name)
            df = numbered.select(*table.schema.names, part, named)
        order = table.sort() if table.sort is not None else []
        writer = df.sortWithinPartitions(part, SLICE.name, *order).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(part, SLICE.name)
        writer.option("compression", CODEC)
        # Keys hardly repeat within a file, so building a dictionary for them is wasted work.
        writer.option(f"parquet.enable.dictionary#{table.key}", "false").parquet(base)
        if units is None:
            units = sorted(self._folders(base, table, f"{label}-"))
        units = list(units)
        with ThreadPoolExecutor(16) as pool:
            sizes = dict(zip(units, pool.map(lambda u: storage.size_of(self.spark, f"{base}/{u}"), units)))
        least = INDEXED_BYTES if len(units) > FULL_UNITS else 0
        if table.indexed and (told := [u for u in units if sizes[u] >= least]):
            fresh = self.read(table, units=told, placed=True)
            hashes = fresh.select(F.xxhash64(table.key).alias("h"), part, SLICE.name)
            index = hashes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            index.partitionBy(part, SLICE.name).parquet(f"{base}/_index")
        log = UnitLog(self.spark, base)
        gone = [] if self.keep_replaced else (log.live() or {}) if replaced is None else replaced
        log.commit(sizes, replaced or (), afresh=replaced is None)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda u: self._delete(base, u), [u for u in gone if u not in sizes]))
        return units

    def _chunk(self, rows: int) -> int:
        """Rows of a unit, for a write of so many rows."""
        least = max(1, self.unit_rows // 2)
        wanted = rows / least
        return least if wanted <= FULL_UNITS else math.ceil(least * math.sqrt(wanted / FULL_UNITS))

    def _delete(self, base: str, unit: str) -> None:
        storage.delete(self.spark, f"{base}/{unit}")
        storage.delete(self.spark, f"{base}/_index/{unit}")

    def vacuum(self, table: TableSpec, keep: timedelta = timedelta(days=1)) -> list[str]:
        """Delete the folders of units that are not live, if they were dropped longer than ``keep`` ago."""
        base, log = self.path(table.layer, table.name), UnitLog(self.spark, self.path(table.layer, table.name))
        before = storage.now_millis() - int(keep.total_seconds() * 1000)
        kept = set(log.live() or ()) | log.dropped_since(before)
        removed = []
        for place in storage.matching(self.spark, f"{base}/{table.part.name}=*/{SLICE.name}=*"):
            unit = "/".join(place.rstrip("/").split("/")[-2:])
            if unit not in kept and storage.modified_millis(self.spark, place) <= before:
                self._delete(base, unit)
                removed.append(unit)
        return removed

    # --- high-water marks ---------------------------------------------------------------------
    # One small file per run and table, written after the table itself is committed. A run that dies
    # before that is repeated from the previous mark, and the upsert makes the repeat harmless.

    def _marks_path(self, table: TableSpec) -> str:
        return f"{self.root}/_marks/{table.full_name}"

    def marks(self, table: TableSpec) -> MarkDict | None:
        path = self._marks_path(table)
        runs = sorted(n for n in storage.child_names(self.spark, path) if n.endswith(".json"))
        if not runs:
            return None
        stored = json.loads(storage.read_text(self.spark, f"{path}/{runs[-1]}"))
        return {k: None if v is None else datetime.fromisoformat(v) for k, v in stored.items()}

    def set_marks(self, table: TableSpec, marks: MarkDict) -> None:
        path = self._marks_path(table)
        runs = sorted(n for n in storage.child_names(self.spark, path) if n.endswith(".json"))
        number = int(runs[-1].removesuffix(".json")) + 1 if runs else 0
        text = json.dumps({k: None if v is None else v.isoformat() for k, v in marks.items()})
        storage.write_text(self.spark, f"{path}/{number:012d}.json", text)
        for old in runs[:-1]:
            storage.delete(self.spark, f"{path}/{old}")

    def clear_marks(self, table: TableSpec) -> None:
        storage.delete(self.spark, self._marks_path(table))

    # --- catalog ------------------------------------------------------------------------------

    def register(self, tables: Iterable[TableSpec]) -> None:
        """Declare databases and tables in the session catalog; their partitions are the live folders."""
        for feed in FEEDS.values():
            path = self.raw_path(feed)
            live = None
            if batches.has_manifest(self.spark, path):
                live = [b.folder for b in batches.live_batches(self.spark, path)]
            self._declare("raw", feed.raw_name, feed.raw_schema.fields, list(RAW_PARTITIONS), live)
        for t in tables:
            self._declare(t.layer, t.name, t.schema.fields, [t.part, SLICE], list(self.live(t) or ()))

    def _declare(
        self, layer: str, name: str, fields: list[T.StructField], parts: list[T.StructField], live: list[str] | None
    ) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer_name(layer)}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*fields, *parts])
        full, path = qualified_name(layer, name), self.path(layer, name)
        storage.ensure_dir(self.spark, path)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(p.name for p in parts)}) LOCATION '{path}'"
        )
        if live is None:
            self.spark.catalog.recoverPartitions(full)
            return
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {full}").collect()}
        gone, new = sorted(known - set(live)), sorted(set(live) - known)
        for verb, folders, between in (("DROP IF EXISTS", gone, ", "), ("ADD IF NOT EXISTS", new, " ")):
            for start in range(0, len(folders), 500):
                specs = between.join(f"PARTITION ({_spec(f)})" for f in folders[start : start + 500])
                self.spark.sql(f"ALTER TABLE {full} {verb} {specs}")


def _spec(folder: str) -> str:
    """``a=1/b=x`` as the values of a PARTITION clause."""

    def value(text: str) -> str:
        return "null" if text == NULL_PARTITION else "'" + unquote(text).replace("'", "\\'") + "'"

    return ", ".join(f"{n}={value(v)}" for n, _, v in (level.partition("=") for level in folder.split("/")))

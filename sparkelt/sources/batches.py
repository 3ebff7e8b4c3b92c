"""Batches of a raw table: their manifest, and their compaction.

Every loaded batch has an entry in ``_batches`` whose name tells its least and greatest load time and
its folder, so one listing says which folders hold rows past a mark. A batch without an entry is not
there yet. Load times grow from batch to batch, so ranges do not overlap, and a compacted folder
supersedes exactly the entries whose range lies within its own: its entry is the swap. Superseded
folders stay on disk for readers that listed them, until a vacuum.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt.sources import storage

EPOCH = datetime(1970, 1, 1)
#: Compacted folders come near to this size; folders of half of it or more are left alone.
TARGET_BYTES = 512 << 20
FILE_BYTES = 128 << 20
#: Compacted folders written side by side.
AT_ONCE = 4
PACK = "pack-"
#: Keys are hashes in hex, which only an entropy coder halves and which hardly repeat within a file.
RAW_FORMAT = {"compression": "zstd", "parquet.enable.dictionary#trip_id": "false"}


def micros(moment: datetime) -> int:
    return (moment - EPOCH) // timedelta(microseconds=1)


@dataclass(frozen=True, order=True)
class Batch:
    """A folder of a raw table; load times in microseconds since 1970."""

    least: int
    greatest: int
    query_id: str
    batch_id: int

    @property
    def entry(self) -> str:
        return f"{self.least:020d}_{self.greatest:020d}@{self.query_id}@{self.batch_id}"

    @property
    def folder(self) -> str:
        day = (EPOCH + timedelta(microseconds=self.least)).date().isoformat()
        return f"load_date={day}/query_id={self.query_id}/batch_id={self.batch_id}"

    @classmethod
    def parse(cls, entry: str) -> Batch:
        times, query_id, batch_id = entry.split("@")
        least, greatest = times.split("_")
        return cls(int(least), int(greatest), query_id, int(batch_id))


def _all(spark: SparkSession, path: str) -> list[Batch]:
    names = storage.child_names(spark, f"{path}/_batches")
    return [Batch.parse(n) for n in names if n.count("@") == 2 and not n.endswith((".tmp", ".crc"))]


def has_manifest(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, f"{path}/_batches")


def split(entries: Iterable[Batch]) -> tuple[list[Batch], list[Batch]]:
    """Live and superseded batches, by load time."""
    live, gone = [], []
    for b in sorted(entries, key=lambda b: (b.least, -b.greatest, b.query_id, b.batch_id)):
        (gone if live and b.greatest <= live[-1].greatest else live).append(b)
    return live, gone


def live_batches(spark: SparkSession, path: str) -> list[Batch]:
    return split(_all(spark, path))[0]


def enter(spark: SparkSession, path: str, batch: Batch, manifest: str = "_batches") -> None:
    """Makes a written folder part of the table. Entering it again changes nothing."""
    place = f"{path}/{manifest}/{batch.entry}"
    if not storage.exists(spark, place):
        storage.write_text(spark, place, "")


def adopt(spark: SparkSession, path: str) -> None:
    """Gives a table its manifest: empty for a new one, else from the load times in its folders."""
    aside = f"_batches.{uuid.uuid4().hex}"
    storage.ensure_dir(spark, f"{path}/{aside}")
    if any(n.startswith("load_date=") for n in storage.child_names(spark, path)):
        rows = spark.read.schema("loaded_at timestamp_ntz, load_date date, query_id string, batch_id long").parquet(path)
        times = [F.min("loaded_at").alias("least"), F.max("loaded_at").alias("greatest")]
        found = rows.groupBy("load_date", "query_id", "batch_id").agg(*times).collect()  # one row per folder
        entries = [Batch(micros(r.least), micros(r.greatest), r.query_id, r.batch_id) for r in found]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda b: enter(spark, path, b, aside), entries))
    storage.rename(spark, f"{path}/{aside}", f"{path}/_batches")


def _bins(batches: list[Batch], sizes: dict[Batch, int], target: int) -> list[list[Batch]]:
    """Runs of neighbouring small batches of a day, each up to the target size."""
    bins: list[list[Batch]] = []
    run: list[Batch] = []
    for b in batches:
        small = sizes[b] < target // 2
        fits = run and sum(sizes[r] for r in run) + sizes[b] <= target
        same_day = run and run[-1].folder.split("/")[0] == b.folder.split("/")[0]
        if run and not (small and fits and same_day):
            bins.append(run)
            run = []
        if small:
            run.append(b)
    return [r for r in [*bins, run] if len(r) > 1]


def compact(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    pending: Iterable[tuple[str, int]] = (),
    target_bytes: int = TARGET_BYTES,
) -> list[Batch]:
    """Small neighbouring batches of a day into one folder each; returns the new ones.

    ``pending`` names batches (query, number) that may be replayed and stay as they are. A folder has a
    file, and a task, for every ``FILE_BYTES``. Rows, load times included, stay the same. A run that dies
    leaves folders without an entry.
    """
    waiting = set(pending)
    runs: list[list[Batch]] = [[]]
    for b in live_batches(spark, path):
        if (b.query_id, b.batch_id) in waiting:
            runs.append([])
        else:
            runs[-1].append(b)
    with ThreadPoolExecutor(16) as pool:
        every = [b for run in runs for b in run]
        sizes = dict(zip(every, pool.map(lambda b: storage.size_of(spark, f"{path}/{b.folder}"), every)))
    bins = [b for run in runs for b in _bins(run, sizes, target_bytes)]

    def pack(run: list[Batch]) -> Batch:
        packed = Batch(run[0].least, run[-1].greatest, f"{PACK}{uuid.uuid4().hex}", 0)
        rows = spark.read.schema(columns).parquet(*[f"{path}/{b.folder}" for b in run])
        rows = rows.coalesce(-(-sum(sizes[b] for b in run) // FILE_BYTES) or 1)
        rows.write.options(**RAW_FORMAT).parquet(f"{path}/{packed.folder}")
        enter(spark, path, packed)
        return packed

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(pack, bins))


def vacuum(spark: SparkSession, path: str, keep: timedelta = timedelta(days=1)) -> list[str]:
    """Deletes superseded folders and those of compactions that died, if older than ``keep``."""
    live, gone = split(_all(spark, path))
    before = storage.now_millis() - int(keep.total_seconds() * 1000)
    removed = []
    for b in gone:
        # Its age counts from the entry that superseded it.
        heir = next(h for h in live if h.least <= b.least and b.greatest <= h.greatest)
        if storage.modified_millis(spark, f"{path}/_batches/{heir.entry}") <= before:
            storage.delete(spark, f"{path}/{b.folder}")
            storage.delete(spark, f"{path}/_batches/{b.entry}")
            removed.append(b.folder)
    known = {b.query_id for b in (*live, *gone)}
    for day in storage.child_names(spark, path):
        names = storage.child_names(spark, f"{path}/{day}") if day.startswith("load_date=") else []
        for name in names:
            query_id = name.removeprefix("query_id=")
            place = f"{path}/{day}/{name}"
            if query_id.startswith(PACK) and query_id not in known and storage.modified_millis(spark, place) <= before:
                storage.delete(spark, place)
                removed.append(f"{day}/{name}")
    return removed

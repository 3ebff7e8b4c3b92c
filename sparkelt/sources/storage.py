"""Shared-filesystem helpers on Spark's own Hadoop FileSystem, so any scheme Spark reads will do."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def ensure_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory; one listing call, empty when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, p = _fs(spark, pattern)
    return [s.getPath().toString() for s in (fs.globStatus(p) or [])]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def modified_millis(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def now_millis() -> int:
    return time.time_ns() // 1_000_000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small control file, complete or absent: written aside, then renamed."""
    fs, p = _fs(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not fs.rename(aside, p):
        raise OSError(f"could not put {path} in place")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not rename {path}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def letting_go(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go once the query that made them has ended, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can see, removed when the session's JVM ends.

    It lies under ``spark.checkpoint.dir``. Only a session whose executors are threads of the driver
    may do without that setting: any folder of the driver is theirs too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sparkelt-")
    path = f"{base.rstrip('/')}/sparkelt/{label}-{uuid.uuid4().hex}"
    ensure_dir(spark, path)
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
    return path

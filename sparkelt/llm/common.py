"""Column helpers and shared storage used by the text operators."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Seconds in which the JVM learns of the objects that Python dropped.
PASSED_ON_S = 1.5
#: What separates words: ASCII white space, or all ASCII but lower-case letters and digits.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
NOT_PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it.

    A plain alias is not enough: the optimizer may inline it into a lambda, which would then
    evaluate it once per array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def words_of(text: Column, between: str) -> Column:
    """All words of a text as an array (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between, -1), "")


def window_hashes(words: Column, size: int) -> Column:
    """A 64-bit hash of every run of ``size`` words, in order; none if there are fewer words."""

    def rolled(hashes: Column) -> Column:
        def at(i: Column) -> Column:
            return F.xxhash64(*[F.get(hashes, i + o) for o in range(size)])

        return F.transform(F.sequence(F.lit(0), F.size(hashes) - size), at)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(
        hashed,
        lambda h: F.when(F.size(h) >= size, rolled(h)).otherwise(F.array().cast("array<bigint>")),
    )


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table written out in the plan, without Python workers."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from the same source tree.

    Where executors do not have that tree, the package is shipped with ``--py-files`` as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see.

    It lies in ``spark.checkpoint.dir``. Where that is unset, a local master gets a temporary
    folder; a cluster gets an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in shared storage: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that nothing refers to any more.

    It does so when the driver's JVM collects its garbage, which on a large heap may be long after a
    written table has made them useless. What Python dropped is garbage there only once the thread
    that passes it on, about once a second, has done so. A first collection frees the plans, and only a
    second one the shuffles that they held.
    """
    gc.collect()
    for pause in (PASSED_ON_S, PASSED_ON_S / 5):
        time.sleep(pause)
        spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

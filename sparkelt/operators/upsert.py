"""Keyed upsert and referential lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, updates: DataFrame, key: str, keys: DataFrame | None = None
) -> DataFrame:
    """Matched keys take the whole new row, other keys are added, nothing is deleted.

    NULL keys match nothing and stay on both sides. ``updates`` must be unique by key. Only its key
    column takes part in the join; Spark broadcasts it when its measured size allows. ``keys`` may
    give the same set of keys by a cheaper plan, repeats included.
    """
    return without_keys(target, updates if keys is None else keys, key).unionByName(updates)


def without_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is none of the given ones; NULL keys stay."""
    return target.join(keys.select(key), key, "left_anti").select(*target.columns)


def merge_into(updates: DataFrame, table: str, key: str) -> None:
    """The same upsert on a catalog table whose format has a native MERGE (Delta, Iceberg, ...)."""
    on = F.expr(f"{table}.{key} = fresh.{key}")
    merge = updates.alias("fresh").mergeInto(table, on)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


#: Bits of a word of a key bitmap, and the most words that are sent to every task (8 MB).
WORD_BITS = 1 << 15
BITMAP_WORDS = 2048


def key_bitmap(parent: DataFrame, pk: str) -> DataFrame:
    """word, bits: the non-NULL integer keys of a table, one bit each, in words of 4 KB.

    Bitmaps are merged on the map side, so a task sends one row per word, however many rows it has.
    """
    key = F.col(pk).cast("long")
    placed = parent.filter(key.isNotNull()).select(
        F.shiftright(key, 15).alias("word"), key.bitwiseAND(F.lit(WORD_BITS - 1)).alias("bit")
    )
    return placed.groupBy("word").agg(F.bitmap_construct_agg("bit").alias("bits"))


def orphans_by_bitmap(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, most_words: int = BITMAP_WORDS
) -> DataFrame:
    """As ``orphans`` for integer keys, the child being scanned once and not shuffled.

    Every key has a bit of its own, so what the bitmap says is exact. Its words are counted first:
    keys that lie so far apart that they take more than ``most_words`` go the way of ``orphans``.
    """
    words = key_bitmap(parent, pk)
    if words.limit(most_words + 1).count() > most_words:
        return orphans(child, fk, parent, pk).select(*child.columns)
    key = F.col(f"_child.{fk}").cast("long")
    found = child.filter(F.col(fk).isNotNull()).alias("_child").join(
        F.broadcast(words.alias("_known")), F.shiftright(key, 15) == F.col("_known.word"), "left"
    )
    return found.filter(~bit_set(F.col("_known.bits"), key)).select("_child.*")


def bit_set(bits: Column, number: Column) -> Column:
    """Whether a number's bit is set in its word; False without a word."""
    bit = number.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("long"), bit.bitwiseAND(F.lit(7))) == 1, F.lit(False))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent.

    Distinct key values are compared first, so a value shared by a third of the rows crosses the
    shuffle once per map task; the full rows are only looked up against the (few) orphan values.
    """
    values = child.select(fk).filter(F.col(fk).isNotNull()).distinct()
    known = parent.select(F.col(pk).alias(fk), F.lit(True).alias("_known"))
    # An outer join: an anti join would be moved below the distinct, onto every row of the child.
    missing = values.join(known, fk, "left").filter(F.col("_known").isNull()).select(fk)
    return child.join(missing, fk, "left_semi")

"""Scalar rules of the models. All are built-in expressions, so they stay in whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkelt.schemas import CLEAN_CODES, UNKNOWN_CODE

NTZ = "timestamp_ntz"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- keys -------------------------------------------------------------------------------------


def trip_key(feed_name: str, id_cols: Iterable[Column | str]) -> Column:
    """SHA-256 over the feed name and the id columns; NULL ids are skipped, as concat_ws does.

    The hash of a text is never NULL. The coalesce says so to the optimizer, which then drops null
    checks on the key instead of hashing once more for them.
    """
    digest = F.sha2(F.concat_ws("||", F.lit(feed_name), *[_col(c) for c in id_cols]), 256)
    return F.coalesce(digest, F.lit(""))


def packed_key(c: Column | str) -> tuple[Column, Column]:
    """A text key as bytes and text, one of them NULL: hex as bytes, which take half the room, else as it is."""
    c = _col(c)
    packed = c.rlike("^([0-9a-f][0-9a-f])+\\z")
    return F.when(packed, F.unhex(c)), F.when(~packed, c)


def unpacked_key(packed: Column | str, text: Column | str) -> Column:
    return F.coalesce(F.lower(F.hex(_col(packed))), _col(text))


# --- codes and flags --------------------------------------------------------------------------


def code_clean(c: Column | str, accepted: Iterable[int] = CLEAN_CODES) -> Column:
    """An accepted code stays; NULL and anything else become the unknown code."""
    return F.when(_col(c).isin(*accepted), _col(c)).otherwise(F.lit(UNKNOWN_CODE).cast("long"))


def positive_flag(c: Column | str) -> Column:
    """missing / invalid (not above zero) / valid."""
    c = _col(c)
    return F.when(c.isNull(), "missing").when(c <= 0, "invalid").otherwise("valid")


def amount_flag(c: Column | str) -> Column:
    """missing / invalid (below zero) / zero / valid."""
    c = _col(c)
    return F.when(c.isNull(), "missing").when(c < 0, "invalid").when(c == 0, "zero").otherwise("valid")


def enum_flag(c: Column | str, accepted: Iterable[int]) -> Column:
    """missing / invalid (not in the list) / valid."""
    c = _col(c)
    return F.when(c.isNull(), "missing").when(~c.isin(*accepted), "invalid").otherwise("valid")


# --- labels -----------------------------------------------------------------------------------


def label_map(c: Column | str, labels: Mapping[int, str], default: str) -> Column:
    """Display label of a code; a literal map needs no join."""
    out = None
    for code, text in labels.items():
        hit = _col(c) == code
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return F.lit(default) if out is None else out.otherwise(default)


def location_name(c: Column | str) -> Column:
    """Zero-padded to three characters; longer ids are cut to three, as LPAD does."""
    return F.concat(F.lit("Location "), F.lpad(_col(c).cast("string"), 3, "0"))


# --- time -------------------------------------------------------------------------------------


def trip_duration(pickup: Column | str, dropoff: Column | str) -> Column:
    """Whole minutes, halves away from zero. Subtracting zone-less timestamps ignores the session zone."""
    seconds = (_col(dropoff) - _col(pickup)).cast("interval second").cast("decimal(20,6)")
    return F.round(seconds.cast("double") / 60, 0)


def night_flag(pickup: Column | str) -> Column:
    """1 from 22:00 up to, not including, 06:00."""
    hour = F.hour(_col(pickup))
    return F.when((hour >= 22) | (hour < 6), 1).otherwise(0)


def weekend_flag(pickup: Column | str) -> Column:
    """1 on Saturday and Sunday (Spark numbers the week 1 = Sunday ... 7 = Saturday)."""
    return F.when(F.dayofweek(_col(pickup)).isin(1, 7), 1).otherwise(0)


def parse_timestamp(c: Column | str) -> Column:
    """ISO text to a zone-less timestamp; junk becomes NULL even in ANSI mode."""
    return _col(c).try_cast(NTZ)


def iso_seconds(c: Column | str) -> Column:
    """Zone-less timestamp to ISO-8601 text, fraction dropped; independent of the session zone."""
    text = F.substring_index(_col(c).cast(NTZ).cast("string"), ".", 1)
    return F.translate(text, " ", "T")

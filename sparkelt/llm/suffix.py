"""Exact removal of repeated byte strings by distributed bucket-pointer refinement.

A suffix array of a corpus need not be built whole to find its strings of WIDTH bytes that occur in
several texts. Every such string holds the same anchor in each of its places: of its Q-grams the
one of the smallest hash. So (1) each text's anchors are dealt out by hash, to learn which occur in
several texts; (2) the places of those anchors, with the bytes of the strings that they anchor, are
dealt out again; (3) within an anchor's bucket the suffixes are refined: initial buckets by bytes,
then by the pair of bucket identifiers here and a bucket length further on, doubling up to WIDTH.

An anchor is half a string long: shorter ones (16 bytes were tried) recur by chance ever more often
as a corpus grows, and each such chance moves and refines strings that no other text holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, let_go, written

WIDTH = 50
Q = 24
#: Bytes hashed at once; positions are packed into the low 20 bits.
PIECE = 1 << 16
#: Texts told apart within a batch, and parts: packed above an anchor's 32 bits into one number.
OWNER_BITS, PART_BITS = 14, 18
#: An anchor in so many texts is dealt out by whole strings, so that no bucket grows with it.
HOT_TEXTS = 20_000
#: One anchor in so many ends a block of strings.
BLOCK_ANCHORS = 16
#: Bytes of text segments refined at once.
REFINE_BYTES = 1 << 19
LAST = 2**63 - 1


# --- anchors --------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as a number."""
    two = data[:-1].astype(np.uint64) | (data[1:].astype(np.uint64) << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    return four[:-4] | (four[4:] << np.uint64(32))


def anchored(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor position of the string from each position on, hash of the Q-gram at each position)."""
    words = _words8(data)
    count = len(data) - Q + 1
    grams = words[:count]
    for at in range(8, Q, 8):
        grams = _mixed(grams * np.uint64(0xA0761D6478BD642F) + words[at : at + count])
    low = (grams & ~np.uint64(0xFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    span, size = WIDTH - Q + 1, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    return (low & np.uint64(0xFFFFF)).astype(np.int64), grams


def _binary(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each begins there (and the last one ends)."""
    column = column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """As _binary, for values that are runs of numbers: all numbers, and where each run begins."""
    data, at = _binary(column)
    return data[at[0] : at[-1]].view(kind), (at - at[0]) // np.dtype(kind).itemsize


def _bytes_of(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers from each bound to the next as binary values."""
    at = bounds.astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(values)]).cast(pa.binary())


def _starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])


def _distinct(values: np.ndarray) -> np.ndarray:
    """As np.unique, which hashes millions of numbers far slower than they sort."""
    values = np.sort(values)
    return values[_starts_of(values)]


def _pieces(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, valid string starts, their text, their position in it), some PIECE bytes at once."""
    n, rows = 0, len(at) - 1
    while n < rows:
        until = max(n + 1, int(np.searchsorted(at, at[n] + PIECE, "right")) - 1)
        begin, end = int(at[n]), int(at[until])
        if end - begin > PIECE:  # one long text
            for offset in range(0, end - begin - WIDTH + 1, PIECE):
                part = data[begin + offset : min(end, begin + offset + PIECE + WIDTH - 1)]
                starts = np.arange(len(part) - WIDTH + 1)
                yield part, starts, np.full(len(starts), n), starts + offset
        else:
            counts = np.maximum(np.diff(at[n : until + 1]) - (WIDTH - 1), 0)
            owner = np.repeat(np.arange(n, until), counts)
            if len(owner):
                place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield data[begin:end], place + np.repeat(at[n:until] - begin, counts), owner, place
        n = until


def _anchor_runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first string, hash of the anchor) of every run of strings with one anchor; no run crosses texts."""
    anchor, grams = anchored(data)
    spot = anchor[starts]
    begin = _starts_of(spot)
    return begin, grams[spot[begin]]


def _parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys >> np.uint64(32)) % np.uint64(parts)


def _short(keys: np.ndarray, parts: int) -> np.ndarray:
    """What is known of an anchor: its part, and 32 bits of its hash."""
    return (_parts_of(keys, parts) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 1 << OWNER_BITS):
            yield b.slice(at, 1 << OWNER_BITS)


def _anchor_blocks(parts: int):
    """Per batch and part: the texts' numbers, how many anchors each has there, and the anchors."""
    low, above = np.uint64(0xFFFFFFFF), np.uint64(32 + OWNER_BITS)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            ids = b.column("tid").to_numpy(zero_copy_only=False)
            found = []
            for data, starts, owner, _ in _pieces(*_binary(b.column("bytes"))):
                begin, key = _anchor_runs(data, starts)
                text = owner[begin].astype(np.uint64) << np.uint64(32)
                found.append((_parts_of(key, parts) << above) | text | (key & low))
            if not found:
                continue
            found = _distinct(np.concatenate(found))
            runs = _starts_of(found >> np.uint64(32))
            part = (found[runs] >> above).astype(np.int32)
            owner = ((found[runs] >> np.uint64(32)) & np.uint64((1 << OWNER_BITS) - 1)).astype(np.int64)
            at = _starts_of(part)
            bounds = np.r_[at, len(runs)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[at], pa.int32()),
                    _bytes_of(ids[owner].astype("<i8"), bounds),
                    _bytes_of(np.diff(np.r_[runs, len(found)]).astype("<u4"), bounds),
                    _bytes_of((found & low).astype("<u4"), np.r_[runs, len(found)][bounds]),
                ],
                names=["part", "ids", "counts", "keys"],
            )

    return emit


def _runs_by(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each value of a column by which they are sorted."""
    held, last = [], None
    for b in batches:
        values = b.column(name).to_numpy(zero_copy_only=False)
        at = _starts_of(values)
        for x, y in zip(at, np.r_[at[1:], len(values)]):
            if held and values[x] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(b.slice(x, y - x))
            last = values[x]
    if held:
        yield last, pa.Table.from_batches(held)


def _shared_in_part(groups: int):
    """Per part and group of texts: the texts' anchors that other texts hold too, and which are hot.

    A row per text and part would be many small ones: as many as a text has anchors, once there are as
    many parts.
    """
    low, up = np.uint64(0xFFFFFFFF), np.uint64(32)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _runs_by(batches, "part"):
            ids, _ = _numbers(rows.column("ids"), "<i8")
            counts, _ = _numbers(rows.column("counts"), "<u4")
            keys, _ = _numbers(rows.column("keys"), "<u4")
            texts, which = np.unique(ids, return_inverse=True)
            group = (texts.view(np.uint64) % np.uint64(groups)).astype(np.int32)
            order = np.argsort(group, kind="stable")
            texts, group = texts[order], group[order]
            rank = np.empty(len(order), np.uint64)
            rank[order] = np.arange(len(order), dtype=np.uint64)
            # copies count once
            pairs = _distinct((keys.astype(np.uint64) << up) | np.repeat(rank[which], counts))
            begin = _starts_of(pairs >> up)
            holders = np.diff(np.r_[begin, len(pairs)])
            hot = pairs[begin[holders > HOT_TEXTS]] >> up
            pairs = pairs[np.repeat(holders > 1, holders)]
            if not len(pairs):
                continue
            pairs = np.sort((pairs << up) | (pairs >> up))
            text, key = (pairs >> up).astype(np.int64), pairs & low
            runs = _starts_of(text)
            at = _starts_of(group[text[runs]])
            bounds = np.r_[at, len(runs)]
            within = np.r_[runs, len(pairs)][bounds]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group[text[runs[at]]], pa.int32()),
                    pa.array(np.full(len(at), part), pa.int32()),
                    _bytes_of(texts[text[runs]].astype("<i8"), bounds),
                    _bytes_of(np.diff(np.r_[runs, len(pairs)]).astype("<u4"), bounds),
                    _bytes_of(key.astype("<u4"), within),
                    _bytes_of(np.isin(key, hot).astype(np.uint8), within),
                ],
                names=["group", "part", "ids", "counts", "keys", "hot"],
            )

    return emit


def _shared_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: its anchors that other texts hold too, and those of them that are hot."""
    for _, rows in _runs_by(batches, "group"):
        ids, at = _numbers(rows.column("ids"), "<i8")
        counts, _ = _numbers(rows.column("counts"), "<u4")
        keys, _ = _numbers(rows.column("keys"), "<u4")
        hot, _ = _numbers(rows.column("hot"), "u1")
        part = np.repeat(rows.column("part").to_numpy().astype(np.uint64), np.diff(at))
        keys = (np.repeat(part, counts) << np.uint64(32)) | keys.astype(np.uint64)
        texts, which = np.unique(ids, return_inverse=True)
        which = np.repeat(which, counts)
        order = np.argsort(which, kind="stable")
        keys, which, hot = keys[order], which[order], hot[order].astype(bool)
        ends = np.cumsum(np.bincount(which, minlength=len(texts)))
        hot_ends = np.cumsum(np.bincount(which[hot], minlength=len(texts)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.int64()), _bytes_of(keys, np.r_[0, ends]), _bytes_of(keys[hot], np.r_[0, hot_ends])],
            names=["tid", "shared", "hot"],
        )


# --- blocks and segments --------------------------------------------------------------------------


def _of_rows(owner: np.ndarray, short: np.ndarray, known: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which anchors are among those known of their own row; rows are a piece's, in order."""
    lo, hi = int(owner[0]), int(owner[-1]) + 1
    mine = known[at[lo] : at[hi]]
    if not len(mine):
        return np.zeros(len(short), bool)
    above = np.uint64(32 + PART_BITS)
    rows = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(at[lo : hi + 1]))
    have = np.sort((rows << above) | mine)
    asked = ((owner - lo).astype(np.uint64) << above) | short
    return have[np.minimum(np.searchsorted(have, asked), len(have) - 1)] == asked


def _blocks(parts: int):
    """Of each text, the runs of strings with shared anchors, cut where their content says.

    Equal stretches of different texts are cut alike, so most of a copy's blocks are whole copies.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            docs = b.column("owner").to_numpy(zero_copy_only=False)
            ids = b.column("tid").to_numpy(zero_copy_only=False)
            shared, hot = _numbers(b.column("shared"), "<u8"), _numbers(b.column("hot"), "<u8")
            for data, starts, owner, place in _pieces(*_binary(b.column("bytes"))):
                run, key = _anchor_runs(data, starts)
                short, text = _short(key, parts), owner[run]
                taken = _of_rows(text, short, *shared)
                cut = ((key >> np.uint64(20)) % np.uint64(BLOCK_ANCHORS)) == 0
                joined = np.r_[False, taken[1:] & taken[:-1] & ~cut[:-1] & (text[1:] == text[:-1])]
                begin = np.flatnonzero(taken & ~joined)
                if not len(begin):
                    continue
                until = np.flatnonzero(taken & ~np.r_[joined[1:], False])
                first, last = run[begin], np.r_[run[1:], len(starts)][until] - 1
                warm = np.flatnonzero(_of_rows(text, short, *hot))
                hot_keys = [b""] * len(begin)
                for n in np.unique(np.searchsorted(begin, warm, "right") - 1):
                    in_block = warm[np.searchsorted(warm, begin[n]) : np.searchsorted(warm, until[n], "right")]
                    hot_keys[n] = np.unique(short[in_block]).astype("<u8").tobytes()
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[owner[first]], pa.int64()),
                        pa.array(ids[owner[first]], pa.int64()),
                        pa.array(place[first], pa.int64()),
                        pa.array([raw[x : y + WIDTH] for x, y in zip(starts[first].tolist(), starts[last].tolist())], pa.binary()),
                        pa.array(hot_keys, pa.binary()),
                    ],
                    names=["owner", "tid", "place", "block", "hot"],
                )

    return emit


def _once(own: np.ndarray, keys: np.ndarray, cut: list[bytes], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first of each distinct segment of a block, the places of all, where each one's places begin).

    A word repeated all over a text gives one segment again and again.
    """
    everyone = np.arange(len(own) + 1)
    if len(_distinct(_mixed(keys) + own.astype(np.uint64))) == len(own):
        return everyone[:-1], place, everyone
    known: dict[tuple[int, bytes], int] = {}
    which = np.array([known.setdefault(x, len(known)) for x in zip(own.tolist(), cut)])
    order = np.argsort(which, kind="stable")
    at = _starts_of(which[order])
    return order[at], place[order], np.r_[at, len(own)]


def _segments(parts: int):
    """Of each distinct block, the bytes of every run of strings with one anchor, by that anchor.

    Equal segments of a block are one, with all its places. A string with a hot anchor is a segment of its own, keyed by its content.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            hot = _numbers(b.column("hot"), "<u8")
            columns = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "first")}
            for data, starts, owner, place in _pieces(*_binary(b.column("block"))):
                begin, keys = _anchor_runs(data, starts)
                warm = _of_rows(owner[begin], _short(keys, parts), *hot)
                if warm.any():
                    counts = np.diff(np.r_[begin, len(starts)])
                    warm, keys = np.repeat(warm, counts), np.repeat(keys, counts)
                    apart = warm.copy()
                    apart[begin] = True
                    begin = np.flatnonzero(apart)
                    keys, warm = keys[begin], warm[begin]
                until = np.r_[begin[1:], len(starts)] - 1
                raw = data.tobytes()
                cut = [raw[x : y + WIDTH] for x, y in zip(starts[begin].tolist(), starts[until].tolist())]
                for n in np.flatnonzero(warm):
                    keys[n] = np.frombuffer(hashlib.blake2b(cut[n], digest_size=8).digest(), np.uint64)[0]
                own = owner[begin]
                first, places, at = _once(own, keys, cut, place[begin])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[first].view(np.int64), pa.int64()),
                        *[pa.array(columns[c][own[first]], pa.int64()) for c in ("a", "b", "first")],
                        _bytes_of(places.astype("<i8"), at),
                        pa.array([cut[n] for n in first.tolist()], pa.binary()),
                    ],
                    names=["key", "a", "b", "first", "places", "segment"],
                )

    return emit


# --- refinement -----------------------------------------------------------------------------------


def _ranked(*columns: np.ndarray) -> np.ndarray:
    """Bucket identifiers: equal exactly where all columns are."""
    value = columns[0]
    for c in columns[1:]:
        value = value.astype(np.uint64) * np.uint64(int(c.max(initial=0)) + 1) + c.astype(np.uint64)
    return np.unique(value, return_inverse=True)[1]


def _buckets(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bucket identifiers by sorting at every length: whatever the bytes, equal only for equal strings."""
    rank, size = _ranked(words), 8
    while 2 * size <= WIDTH:
        rank = _ranked(rank[:-size], rank[size:]) if len(rank) > size else rank
        size *= 2
    return _ranked(rank[starts], rank[starts + WIDTH - size])


def _named(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bucket identifiers that need no sorting: a mix of the pair of identifiers here and further on."""
    factor = np.uint64(0xA0761D6478BD642F)
    name, size = words, 8
    while 2 * size <= WIDTH:
        name = _mixed(name[:-size] * factor + name[size:]) if len(name) > size else name
        size *= 2
    return _mixed(name[starts] * factor + name[starts + WIDTH - size])


def smallest_owner(data: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For the string of WIDTH bytes at every start: the smallest owner of an equal one.

    Buckets are sorted once, by their last identifiers. Members are then compared with the first one
    byte by byte; should two strings ever share an identifier, identifiers are made by sorting.
    """
    if not len(starts):
        return owner
    words = _words8(np.r_[data, np.zeros(7, np.uint8)])
    out = owner.copy()
    for exact in (False, True):
        final = _buckets(words, starts) if exact else _named(words, starts)
        order = np.argsort(final)
        final = final[order]
        same = final[1:] == final[:-1]
        many = np.r_[False, same] | np.r_[same, False]  # alone in a bucket: settled
        order, final = order[many], final[many]
        if not len(order):
            return out
        begin = _starts_of(final)
        counts = np.diff(np.r_[begin, len(order)])
        here = starts[order]
        there = np.repeat(here[begin], counts)
        if exact or all((words[here + at] == words[there + at]).all() for at in (*range(0, WIDTH - 8, 8), WIDTH - 8)):
            break
    out[order] = np.repeat(np.minimum.reduceat(owner[order], begin), counts)
    return out


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key, some REFINE_BYTES of segments at once, no key in two tables."""
    held, size, last = [], 0, None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column("key").to_numpy(zero_copy_only=False)
        _, bounds = _binary(b.column("segment"))
        new = np.flatnonzero(np.r_[keys[0] != last, keys[1:] != keys[:-1]])
        at = 0
        while at < b.num_rows:
            enough = np.searchsorted(bounds, bounds[at] + max(REFINE_BYTES - size, 0))
            n = np.searchsorted(new, enough)
            until = int(new[n]) if n < len(new) else b.num_rows
            if until > at:
                held.append(b.slice(at, until - at))
                size += int(bounds[until] - bounds[at])
            if until < b.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            at = until
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment: runs (start in its block, count, smallest owner) of strings an earlier text holds."""
    for rows in _whole_buckets(batches):
        a, b, first = (rows.column(c).to_numpy() for c in ("a", "b", "first"))
        places, places_at = _numbers(rows.column("places"), "<i8")
        data, at = _binary(rows.column("segment"))
        data, at = data[at[0] : at[-1]], at - at[0]
        count = np.diff(at) - WIDTH + 1
        seg = np.repeat(np.arange(len(count)), count)
        offset = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
        least = smallest_owner(data, at[seg] + offset, first[seg])
        wanted = np.flatnonzero(least < first[seg])
        seg, offset, least = seg[wanted], offset[wanted], least[wanted]
        begin = _starts_of(seg, offset - np.arange(len(offset)), least)
        # a run is told for all places of its segment
        often = np.diff(places_at)[seg[begin]]
        length = np.repeat(np.diff(np.r_[begin, len(seg)]), often)
        nth = np.arange(len(length)) - np.repeat(np.cumsum(often) - often, often)
        begin = np.repeat(begin, often)
        own = seg[begin]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(a[own], pa.int64()),
                pa.array(b[own], pa.int64()),
                pa.array(places[places_at[own] + nth] + offset[begin], pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(least[begin], pa.int64()),
            ],
            names=["a", "b", "offset", "count", "least"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the repeated strings of a text to spans and hashes what is left."""
    for b in batches:
        runs = b.column("runs")
        text = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
        start, count = (runs.flatten().field(n).to_numpy(zero_copy_only=False) for n in ("start", "count"))
        order = np.lexsort((start, text))
        text, start, end = text[order], start[order], (start + count)[order] + WIDTH - 1
        reach = np.zeros(0, np.int64)
        if len(text):  # texts are laid out one after the other, with a gap
            reach = text * (int(end.max()) + 1)
            until = np.maximum.accumulate(end + reach)
            begin = np.flatnonzero(np.r_[True, start[1:] + reach[1:] > until[:-1]])
            last = np.r_[begin[1:], len(text)] - 1
            text, start, end = text[begin], start[begin], until[last] - reach[last]
        bounds = np.searchsorted(text, np.arange(len(runs) + 1))
        kept = []
        for n, value in enumerate(b.column("bytes")):
            data, digest, at = value.as_buffer(), hashlib.sha256(), 0
            for x, y in zip(start[bounds[n] : bounds[n + 1]].tolist(), end[bounds[n] : bounds[n + 1]].tolist()):
                digest.update(data[at:x])
                at = y
            digest.update(data[at:])
            kept.append(digest.hexdigest())
        removed = np.r_[0, np.cumsum(end - start)]
        pairs = pa.ListArray.from_arrays(
            pa.array(np.arange(0, 2 * len(start) + 1, 2), pa.int32()), pa.array(np.c_[start, end].ravel(), pa.int64())
        )
        yield pa.RecordBatch.from_arrays(
            [
                b.column("owner"),
                b.column("tid"),
                pa.array(removed[bounds[1:]] - removed[bounds[:-1]], pa.int64()),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(kept, pa.string()),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pairs),
            ],
            names=["owner", "tid", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def _shared_blocks(told: DataFrame, first: DataFrame, parts: int) -> DataFrame:
    """owner, tid, place, block and its hot anchors, of all stretches whose anchors texts share."""
    anchors = told.filter(F.col("n_bytes") >= WIDTH).select("tid", "bytes").mapInArrow(
        _anchor_blocks(parts), "part int, ids binary, counts binary, keys binary"
    )
    shared = (
        anchors.repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(_shared_in_part(parts), "group int, part int, ids binary, counts binary, keys binary, hot binary")
        .repartition(parts, "group")
        .sortWithinPartitions("group")
        .mapInArrow(_shared_of_texts, "tid long, shared binary, hot binary")
    )
    wanted = shared.join(first, "tid")
    return written(
        told.select("owner", "tid", "tid2", "bytes")
        .join(wanted, ["owner", "tid", "tid2"])
        .select("owner", "tid", "bytes", "shared", "hot")
        .mapInArrow(_blocks(parts), "owner long, tid long, place long, block binary, hot binary"),
        "blocks",
    )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans of every row of ``docs``.

    Equal texts are settled by their hashes first: only the one of the smallest doc_id takes part,
    the others are removed whole. Equal blocks are combined before they move, hot anchors are dealt
    out by whole strings, and no bucket or text is emitted as pairs. Defined results: a null
    text counts as empty; texts below WIDTH bytes stay; a null doc_id counts as larger than any
    other, and rows of equal doc_id never remove each other's strings; an empty table gives an
    empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    importable(spark)
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << PART_BITS)
    text = F.coalesce(F.col("text"), F.lit(""))
    told = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("owner"),
        F.xxhash64(text).alias("tid"),
        F.xxhash64(text, F.lit(1)).alias("tid2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.encode(text, "UTF-8").alias("bytes"),
    )
    narrow = written(told.select("doc_id", "owner", "tid", "tid2", "n_bytes", F.sha2("bytes", 256).alias("whole")), "texts")
    first = narrow.groupBy("tid", "tid2").agg(F.min("owner").alias("owner"))

    blocks = _shared_blocks(told, first, parts)
    let_go(spark)
    named = blocks.withColumns({"a": F.xxhash64("block"), "b": F.xxhash64("block", F.lit(1))})
    # A block that an earlier text holds whole is settled; each distinct one is refined once.
    distinct = named.groupBy("a", "b").agg(
        F.min("owner").alias("first"), F.first("block").alias("block"), F.first("hot").alias("hot")
    )
    runs = (
        distinct.mapInArrow(_segments(parts), "key long, a long, b long, first long, places binary, segment binary")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_refine, "a long, b long, offset long, count long, least long")
    )
    # Segments are the largest shuffle, texts the next: neither is left on disk beside the other.
    runs = written(runs, "runs")
    let_go(spark)
    places = named.select("a", "b", "owner", "tid", "place", (F.octet_length("block") - WIDTH + 1).alias("strings"))
    earliest = places.groupBy("a", "b").agg(F.min("owner").alias("first"))
    placed = places.join(earliest, ["a", "b"])
    copied = placed.filter("owner > first").select(
        "owner", "tid", F.col("place").alias("start"), F.col("strings").cast("long").alias("count")
    )
    partly = (
        placed.filter("owner = first")
        .join(runs, ["a", "b"])
        .filter("least < owner")
        .select("owner", "tid", (F.col("place") + F.col("offset")).alias("start"), "count")
    )
    removed = copied.unionByName(partly).groupBy("owner", "tid").agg(F.collect_set(F.struct("start", "count")).alias("runs"))
    removed = written(removed, "removed")
    let_go(spark)
    cut = (
        told.select("owner", "tid", "bytes")
        .join(removed, ["owner", "tid"])
        .mapInArrow(
            _cut, "owner long, tid long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
        )
        .dropDuplicates(["owner", "tid"])
    )
    all_rows = narrow.join(first.withColumnRenamed("owner", "kept"), ["tid", "tid2"])
    whole = (F.col("owner") > F.col("kept")) & (F.col("n_bytes") >= WIDTH)
    mine = F.col("n_removed").isNotNull() & (F.col("owner") == F.col("kept"))
    empty = hashlib.sha256(b"").hexdigest()
    return all_rows.join(cut, ["owner", "tid"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).when(mine, F.col("n_removed")).otherwise(0).alias("n_removed"),
        F.when(whole, 1).when(mine, F.col("n_spans")).otherwise(0).cast("long").alias("n_spans"),
        F.when(whole, F.lit(empty)).when(mine, F.col("kept_sha256")).otherwise(F.col("whole")).alias("kept_sha256"),
        F.when(whole, F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes"))))
        .when(mine, F.col("spans"))
        .otherwise(F.array().cast("array<array<bigint>>"))
        .alias("spans"),
    )

"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are compared in three rotations, so that of any two that differ in at most two bits
at least one rotation shares the leading block. Under each rotation they are sorted by Gray rank:
codes with a common prefix then stand together, and neighbours differ in few bits. Runs of
neighbours are the index's leaves. The bits on which all codes of a node agree are its masked
pattern; a child keeps only what its parent's pattern does not say. A search adds up the
differences on the way down and drops a node, with all below it, once they exceed the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, ascii_lower, importable, let, words_of, written
from .components import stars

SHINGLE = 3
MAX_BITS = 2
#: Leading blocks of the three rotations: (rotation to the left, bits of the block).
BLOCKS = ((0, 22), (22, 21), (43, 21))
LEAF, FANOUT = 32, 16
#: Codes of an index partition, and pairs looked at together.
CODES_PER_PART = 400_000
PAIRS_AT_ONCE = 2_000_000
HASHES_AT_ONCE = 1 << 18


# --- fingerprints ---------------------------------------------------------------------------------


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of every shingle, repeats included; of all words if there are fewer."""

    def rolled(words: Column) -> Column:
        def at(i: Column) -> Column:
            return F.xxhash64(F.concat_ws(" ", *[F.get(words, i + o) for o in range(size)]))

        return (
            F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), at))
            .when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " "))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(words_of(ascii_lower(F.coalesce(text, F.lit(""))), WHITE_SPACE), rolled)


def majority(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every run of hashes, the bits set in over half of them (none: zero)."""
    runs = len(offsets) - 1
    sizes = np.diff(offsets)
    counts = np.zeros((runs, 64), np.int64)
    owner = np.repeat(np.arange(runs), sizes)
    first = offsets[0]
    for at in range(0, len(owner), HASHES_AT_ONCE):
        own = owner[at : at + HASHES_AT_ONCE]
        part = values[first + at : first + at + HASHES_AT_ONCE].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts[own[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
    set_bits = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, key (a hash of the text) and fp of every row of ``docs`` (doc_id, text)."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = b.column("hashes")
            values = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
            fps = majority(values, hashes.offsets.to_numpy()).view(np.int64)
            columns = [b.column("doc_id"), b.column("key"), pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "fp"])

    importable(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        shingle_hashes(F.col("text"), size).alias("hashes"),
    ).mapInArrow(fold, "doc_id long, key long, fp long")


# --- the index ------------------------------------------------------------------------------------


def _rotated(fp: Column, by: int) -> Column:
    if not by:
        return fp
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def _gray_rank(code: Column) -> Column:
    """Rank in Gray order; the flipped top bit makes signed order the unsigned one."""
    for by in (1, 2, 4, 8, 16, 32):
        code = let(code, _folded_by(by))
    return code.bitwiseXOR(F.lit(-(2**63)))


def _folded_by(by: int):
    return lambda code: code.bitwiseXOR(F.shiftrightunsigned(code, by))


def _unrotated(code: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64)
    back = np.uint64(64) - by
    return np.where(by == 0, code, (code >> by) | (code << (back % np.uint64(64))))


class Index:
    """The hierarchy over codes sorted by group (rotation and leading block) and Gray rank."""

    def __init__(self, codes: np.ndarray, groups: np.ndarray):
        self.codes = codes
        cuts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(codes) else np.zeros(0, int)
        self.keys = groups[cuts]
        bounds = np.r_[cuts, len(codes)].astype(np.int64)
        #: Levels from the leaves up: (begin, end) of the children, mask and pattern of each node.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        every, some, width = codes, codes, LEAF
        while True:
            sizes = np.diff(bounds)
            per = -(-sizes // width)
            starts = np.r_[0, np.cumsum(per)]
            within = np.arange(starts[-1]) - np.repeat(starts[:-1], per)
            begin = np.repeat(bounds[:-1], per) + within * width
            end = np.minimum(begin + width, np.repeat(bounds[1:], per))
            if len(begin):
                every, some = np.bitwise_and.reduceat(every, begin), np.bitwise_or.reduceat(some, begin)
            self.levels.append((begin, end, ~(every ^ some), every))
            bounds, width = starts.astype(np.int64), FANOUT
            if not len(per) or per.max() <= 1:
                break
        #: What a node says beyond its parent.
        self.own = [level[2].copy() for level in self.levels]
        for n in range(len(self.levels) - 1):
            begin, end, mask, _ = self.levels[n + 1]
            self.own[n] &= ~np.repeat(mask, end - begin)

    def search(self, queries: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, code) by position, within their group and at most MAX_BITS apart."""
        if not len(self.keys):
            return
        root = np.minimum(np.searchsorted(self.keys, groups), len(self.keys) - 1)
        known = np.flatnonzero(self.keys[root] == groups)
        yield from self._down(len(self.levels) - 1, queries, known, root[known], np.zeros(len(known), np.int8))

    def _down(self, n, queries, q, nodes, spent) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        begin, end, _, pattern = self.levels[n]
        spent = spent + np.bitwise_count((queries[q] ^ pattern[nodes]) & self.own[n][nodes]).astype(np.int8)
        left = spent <= MAX_BITS
        q, nodes, spent = q[left], nodes[left], spent[left]
        sizes = end[nodes] - begin[nodes]
        total = np.cumsum(sizes)
        at = 0
        while at < len(q):  # as many nodes at once as bound the pairs
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
            size = sizes[at:stop]
            low = np.repeat(begin[nodes[at:stop]] - np.r_[0, np.cumsum(size)[:-1]], size)
            below = low + np.arange(len(low))
            who, so_far = np.repeat(q[at:stop], size), np.repeat(spent[at:stop], size)
            if n:
                yield from self._down(n - 1, queries, who, below, so_far)
            else:
                near = np.bitwise_count(queries[who] ^ self.codes[below]) <= MAX_BITS
                yield who[near], below[near]
            at = stop


class Union:
    """Smallest label of every node under the links seen so far."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _group(rotation: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Rotation and Gray rank of the leading block: ascends in the order that codes are sorted in."""
    rank = codes.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    bits = np.array([b for _, b in BLOCKS])[rotation]
    return (rotation.astype(np.uint64) << np.uint64(32)) | (rank >> (64 - bits).astype(np.uint64))


def _star_links(codes: np.ndarray, rotation: np.ndarray, label: np.ndarray) -> pd.DataFrame:
    plain = _unrotated(codes, np.array([r for r, _ in BLOCKS])[rotation]).view(np.int64)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"u": plain[moved], "v": plain[label[moved]]})


def _search_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links inside index partitions, and from codes routed there, as spanning stars.

    Rows come by partition, its own codes (kind 0) first. Only those are held; routed codes are
    searched as they stream in.
    """
    part, own, index = None, [], None

    def built(own: list[pd.DataFrame]):
        f = pd.concat(own, ignore_index=True)
        rotation, codes = f["r"].to_numpy(np.int64), f["code"].to_numpy(np.int64).view(np.uint64)
        groups = _group(rotation, codes)
        index = Index(codes, groups)
        shared = np.flatnonzero(np.r_[False, groups[1:] == groups[:-1]] | np.r_[groups[1:] == groups[:-1], False])
        union = Union(len(codes))
        for q, c in index.search(codes[shared], groups[shared]):
            union.add(shared[q], c)
        return (index, codes, rotation), _star_links(codes, rotation, union.label)

    for f in frames:
        for p, rows in f.groupby("pid", sort=True):
            if p != part:
                if own:
                    yield built(own)[1]
                part, own, index = p, [], None
            mine, routed = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
            if len(mine):
                own.append(mine)
            if len(routed):
                if index is None:
                    index, links = built(own)
                    own = []
                    yield links
                found, codes, rotation = index
                r, q = routed["r"].to_numpy(np.int64), routed["code"].to_numpy(np.int64).view(np.uint64)
                union = Union(len(codes) + len(q))
                for a, b in found.search(q, _group(r, q)):
                    union.add(a + len(codes), b)
                yield _star_links(np.r_[codes, q], np.r_[rotation, r], union.label)
    if own:
        yield built(own)[1]


def links(fps: DataFrame) -> DataFrame:
    """Links (u, v) that connect all of ``fps`` (fp, distinct) at most MAX_BITS apart, and no others.

    Codes are range-partitioned by rotation and Gray rank, so even one block that holds a third of
    all codes is spread over equal partitions. Within a partition they meet through its index.
    Blocks cut by a partition bound are searched across: their slices' masked patterns (two per
    partition at most, a bound that does not depend on the data) route each code to those other
    slices that it can match. Each partition returns a spanning forest, not pairs.
    """
    importable(fps.sparkSession)
    fps = written(fps, "fingerprints")
    parts = max(1, -(-3 * fps.count() // CODES_PER_PART))
    parts = max(parts, min(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts * 8))
    turned = F.array(
        *[
            F.struct(F.lit(r).alias("r"), _rotated(F.col("fp"), by).alias("code"), F.lit(bits).alias("bits"))
            for r, (by, bits) in enumerate(BLOCKS)
        ]
    )
    codes = (
        fps.select(F.inline(turned))
        .withColumn("top", F.expr("shiftrightunsigned(code, 64 - bits)"))
        .withColumn("rank", _gray_rank(F.col("code")))
        .repartitionByRange(parts, "r", "rank")
        .sortWithinPartitions("r", "rank")
        .select(F.spark_partition_id().alias("pid"), "r", "top", "rank", "code")
    )
    codes = written(codes, "codes")
    ends = codes.groupBy("pid").agg(
        F.min(F.struct("r", "rank", "top")).alias("a"), F.max(F.struct("r", "rank", "top")).alias("b")
    )
    cut = (
        ends.select("pid", F.explode(F.array_distinct(F.array(F.struct("a.r", "a.top"), F.struct("b.r", "b.top")))).alias("k"))
        .groupBy("k.r", "k.top")
        .agg(F.count("*").alias("slices"))
        .filter("slices > 1")
    )
    slices = (
        codes.join(F.broadcast(cut), ["r", "top"])
        .groupBy("pid", "r", "top")
        .agg(F.bit_and("code").alias("every"), F.bit_or("code").alias("some"))
        .select(F.col("pid").alias("to"), "r", "top", F.col("every").alias("pattern"), F.bitwise_not(F.col("every").bitwiseXOR(F.col("some"))).alias("mask"))
    )
    slices = written(slices, "slices")
    spent = F.bit_count(F.col("code").bitwiseXOR(F.col("pattern")).bitwiseAND(F.col("mask")))
    routed = (
        codes.join(F.broadcast(slices), ["r", "top"])
        .filter((F.col("to") > F.col("pid")) & (spent <= MAX_BITS))
        .select(F.col("to").alias("pid"), F.lit(1).alias("kind"), "r", "rank", "code")
    )
    given = codes.select("pid", F.lit(0).alias("kind"), "r", "rank", "code").unionByName(routed)
    return (
        given.repartition(parts, "pid")
        .sortWithinPartitions("pid", "kind", "r", "rank")
        .select("pid", "kind", "r", "code")
        .mapInPandas(_search_part, "u long, v long")
    )


# --- documents ------------------------------------------------------------------------------------


def grouped(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, key, fp, root and component_id of every row of ``docs`` (doc_id, text).

    Rows of one root are connected by links of at most MAX_BITS bits; component_id is the smallest
    doc_id among them. Equal fingerprints are one class, so copies are never paired. Defined
    results: null, empty and blank texts have fingerprint zero and are linked like any other;
    repeated rows get a row each; null doc_ids stay and do not count as smallest (component_id is
    null if the component has no other); an empty table gives an empty table.
    """
    fps = written(fingerprints(docs, size), "simhash")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    forest = stars(links(classes.select("fp")))
    rooted = classes.join(forest, classes["fp"] == forest["u"], "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.drop("least").join(smallest, "root")
    return fps.join(named, "fp")


def dedup(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row of each near-duplicate group, that of the smallest doc_id, with its own columns."""
    members = grouped(docs, size)
    kept = members.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("k")
    ).select(F.col("k.doc_id").alias("id"), F.col("k.key").alias("key"), F.lit(True).alias("stays"))
    packed = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("whole"),
    )
    same = packed["id"].eqNullSafe(kept["id"]) & (packed["key"] == kept["key"])
    found = packed.join(kept, same, "left_semi").dropDuplicates(["id", "key"])
    return found.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])

"""How far sources of a language diverge in their use of terms, all pairs of sources, in whole numbers.

With p the smoothed share of a term in a group and q that in a peer, both in billionths, the
divergence is the sum over the language's vocabulary of floor((p - q)^2 / q). Most groups lack most
terms, whose share then is the group's baseline. Sums therefore start from the baselines, and the
sparse part is a product of the group-by-term table with its transpose, row by row after Gustavson:
each group runs through the term-major index at its own terms and scatters what differs from the
baselines into a dense accumulator with a cell per peer. Posting pairs exist in no table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, written

#: A term is kept if so many documents of its language hold it.
MIN_DOCS = 3
SCALE = 1_000_000_000
#: Ranks kept of a group's most telling terms.
TOP = 200
#: Texts taken out of a batch at once, entries counted before they are passed on, cells of
#: accumulators held before they are passed on, and elements of a step's arrays.
TEXTS_AT_ONCE = 256
ENTRIES = 200_000
CELLS = 4_000_000
STEP = 1 << 20

# ASCII letters in lower case, all bytes of other characters as they are, the rest to spaces.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# --- counts ---------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by group and term, added up as far as memory is set aside for it."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def passed_on() -> pa.RecordBatch:
        langs, sources, terms, ns, docs = [], [], [], [], []
        for (lang, source), (total, seen) in held.items():
            langs += [lang] * (len(total) + 1)
            sources += [source] * (len(total) + 1)
            terms += [None, *[t.decode() for t in total]]
            ns += [0, *total.values()]
            docs += [0, *[seen[t] for t in total]]
        held.clear()
        columns = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.string())]
        columns += [pa.array(ns, pa.int64()), pa.array(docs, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
            for lang, source, text in zip(*[c.to_pylist() for c in batch.slice(start, TEXTS_AT_ONCE).columns]):
                total, seen = held.setdefault((lang, source), (Counter(), Counter()))
                words = text.translate(_BYTES).split()
                total.update(words)
                seen.update(set(words))
            if sum(len(total) for total, _ in held.values()) > ENTRIES:
                yield passed_on()
    if held:
        yield passed_on()


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, whole and lead: occurrences of kept terms by group, and by language.

    ``lead`` marks one row of each term of a language. Every group has a further row without a term.
    """
    importable(docs.sparkSession)

    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    texts = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of("text").cast("binary").alias("text"))
    found = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # Grouped by source too, so that the commonest terms are added up in as many places as there
    # are sources; what is left of a term after that is a row per source.
    counts = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    lead = F.row_number().over(term.orderBy("source")) == 1
    counts = counts.withColumns({"whole": F.sum("n").over(term), "held": F.sum("docs").over(term), "lead": lead})
    kept = counts.filter(F.col("term").isNull() | (F.col("held") >= min_docs))
    return kept.select("lang", "source", "term", "n", "whole", "lead")


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), exact."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    below = F.greatest(total + size, F.lit(1)).cast("decimal(19,0)")
    return F.call_function("div", above, below) + 1


def groups_of(kept: DataFrame) -> DataFrame:
    """lang, source, total, size, whole_total, zero, row, peers: one row per group.

    ``size`` is the language's number of kept terms, ``zero`` the group's share of a term that it
    lacks, ``row`` the group's number in its language, which has ``peers`` groups.
    """
    leads = F.sum((F.col("lead") & F.col("term").isNotNull()).cast("long"))
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), leads.alias("leads"))
    lang = Window.partitionBy("lang")
    named = groups.select(
        "lang",
        "source",
        "total",
        F.sum("leads").over(lang).alias("size"),
        F.sum("total").over(lang).alias("whole_total"),
        (F.row_number().over(lang.orderBy("source")) - 1).alias("row"),
        F.count(F.lit(1)).over(lang).alias("peers"),
    )
    return named.withColumn("zero", share(F.lit(0), F.col("total"), F.col("size")))


# --- accumulators ---------------------------------------------------------------------------------


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


CELL = "lang string, g int, h int, value long"


def _cells(lang: list, g: np.ndarray, h: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(lang, pa.string()), pa.array(g, pa.int32()), pa.array(h, pa.int32()), pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "g", "h", "value"])


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of a column of struct arrays."""
    lists = batch.column(name)
    inner = lists.flatten()
    fields = {f.name: inner.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i, f in enumerate(inner.type)}
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), fields


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of all pairs of groups that share a term, from rows of the term-major index."""
    rows: dict[tuple, np.ndarray] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, g), cells in rows.items():
            h = np.flatnonzero(cells)
            yield _cells([lang] * len(h), np.full(len(h), g), h, cells[h])
        rows.clear()

    for batch in batches:
        offsets, post = _flat(batch, "posts")
        langs = batch.column("lang").to_pylist()
        peers = batch.column("peers").to_pylist()
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(batch.num_rows), sizes)
        codes = batch.column("lang").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        row, share_, zero = post["row"], post["share"], post["zero"]
        # Row-major order of the batch's own part: the postings of one group after the other.
        order = np.lexsort((row, codes[owner]))
        key = np.stack([codes[owner][order], row[order]])
        cuts = np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1
        for own in np.split(order, cuts) if len(order) else []:
            first = own[0]
            at = (langs[owner[first]], int(row[first]))
            if at not in rows:
                if sum(map(len, rows.values())) > CELLS:
                    yield from passed_on()
                rows[at] = np.zeros(peers[owner[first]], np.int64)
            width = max(1, STEP // int(sizes[owner[own]].max()))
            for part in (own[i : i + width] for i in range(0, len(own), width)):
                lengths = sizes[owner[part]]
                ends = np.cumsum(lengths)
                met = np.arange(ends[-1]) + np.repeat(offsets[owner[part]] - (ends - lengths), lengths)
                p, q = np.repeat(share_[part], lengths), share_[met]
                p0, q0 = zero[first], zero[met]
                np.add.at(rows[at], row[met], _f(p, q) - _f(p, q0) - _f(p0, q) + _f(p0, q0))
    yield from passed_on()


def _baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dense part: every group's shares against every peer's baseline, and the other way round."""
    for batch in batches:
        counted_at, counted = _flat(batch, "shares")
        zeros_at, zeros = _flat(batch, "zeros")
        langs, own = batch.column("lang").to_pylist(), batch.column("row").to_pylist()
        sizes = batch.column("size").to_pylist()
        for i in range(batch.num_rows):
            q0 = zeros["zero"][zeros_at[i] : zeros_at[i + 1]]
            p0 = q0[own[i]]
            down = sizes[i] * _f(p0, q0)
            across = np.zeros_like(q0)
            span = slice(counted_at[i], counted_at[i + 1])
            shares, times = counted["share"][span], counted["times"][span]
            for part in range(0, len(shares), max(1, STEP // len(q0))):
                p = shares[part : part + max(1, STEP // len(q0)), None]
                m = times[part : part + max(1, STEP // len(q0)), None]
                down = down + (m * (_f(p, q0) - _f(p0, q0))).sum(axis=0)
                across = across + (m * (_f(q0, p) - _f(q0, p0))).sum(axis=0)
            peers = np.arange(len(q0))
            yield _cells([langs[i]] * len(q0), np.full(len(q0), own[i]), peers, down)
            yield _cells([langs[i]] * len(q0), peers, np.full(len(q0), own[i]), across)


# --- results --------------------------------------------------------------------------------------


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, peer and value: the divergence of every group from every other of its language.

    ``kept`` and ``groups`` are ``vocabulary`` and ``groups_of``, written out.
    """
    importable(kept.sparkSession)
    used = groups.select("lang", "source", "row", "peers", "zero", "total", "size")
    shares = kept.filter("term IS NOT NULL").join(used, ["lang", "source"])
    shares = shares.withColumn("share", share(F.col("n"), F.col("total"), F.col("size")))
    index = shares.groupBy("lang", "term", "peers").agg(F.collect_list(F.struct("row", "share", "zero")).alias("posts"))
    sparse = index.filter(F.size("posts") > 1).select("lang", "peers", "posts").mapInArrow(_scatter, CELL)

    # A group's shares take few different values, as they follow from counts.
    times = shares.groupBy("lang", "row", "share").agg(F.count(F.lit(1)).alias("times"))
    times = times.groupBy("lang", "row").agg(F.collect_list(F.struct("share", "times")).alias("shares"))
    zeros = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("row", "zero"))).alias("zeros"))
    none = F.array().cast(times.schema["shares"].dataType)
    rows = groups.select("lang", "row", "size").join(times, ["lang", "row"], "left").join(zeros, "lang")
    rows = rows.withColumn("shares", F.coalesce("shares", none))
    dense = rows.select("lang", "row", "size", "shares", "zeros").mapInArrow(_baselines, CELL)

    value = F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")
    summed = sparse.unionByName(dense).filter("g <> h").groupBy("lang", "g", "h").agg(value)
    own = groups.select("lang", F.col("row").alias("g"), "source")
    peer = groups.select("lang", F.col("row").alias("h"), F.col("source").alias("peer"))
    return summed.join(own, ["lang", "g"]).join(peer, ["lang", "h"]).select("lang", "source", "peer", "value")


def telling_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, term, value, rank: terms that a group uses more than its language, by divergence."""
    used = groups.select("lang", "source", "total", "size", "whole_total")
    rows = kept.filter("term IS NOT NULL AND n > 0").join(used, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("size"))
    q = share(F.col("whole"), F.col("whole_total"), F.col("size"))
    rows = rows.select("lang", "source", "term", p.alias("p"), q.alias("q")).filter("p > q")
    rows = rows.select("lang", "source", "term", F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group of ``docs``.

    Part ``pair``: every other source of the language with its divergence, all ranks. Part ``term``:
    the ``top`` terms that most set the group apart from its language. Ranks go by value, greatest
    first, ties by the item's bytes. Defined results: null lang, source and text are empty; a group
    without terms has baseline shares only; a language without kept terms has divergence 0 and no
    terms; repeated rows count each; an empty table gives an empty one; other columns are left out.
    """
    kept = written(vocabulary(docs, min_docs), "vocabulary")
    groups = written(groups_of(kept), "groups")
    found = pairs(kept, groups)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "peer")
    found = found.withColumn("rank", F.row_number().over(order))
    columns = ("lang", "source", "part", "item", "value", "rank")
    of_pairs = found.withColumns({"part": F.lit("pair"), "item": F.col("peer")}).select(*columns)
    terms = telling_terms(kept, groups, top).withColumns({"part": F.lit("term"), "item": F.col("term")})
    return of_pairs.unionByName(terms.select(*columns))

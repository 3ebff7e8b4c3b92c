"""Line dedup by a log-template tree: lines that recur across texts, variable fields aside, go.

A line is routed by its number of tokens and by its leading tokens, fields generalised, to a leaf.
Within a leaf, the values of each position are counted over the texts: a value that recurs enough
stays literal, any other is a variable field. A line's template is what stays literal of it. All
lines of a recurring template go, but for those of the text that holds it first, so nothing is lost
from the corpus. Most lines are alone in their leaf; a bitmap of fixed size tells which are not, and
only those move: once, to their leaf, where a task counts values and templates of many leaves at a
time. Leaves too large for a task are counted by shuffles instead, value by value, by the same rules.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import importable, written

#: A template is boilerplate once the texts beyond the first that hold it repeat so many literal
#: tokens; a value of a position is literal once it stands for as many.
REPEATED = 30
#: Leading tokens on the path to a leaf, and the share of a template's tokens that must be literal.
LEADING = 2
LITERAL = 0.5
#: Tokens that are fields wherever they stand: with a digit, addresses, links.
FIELD = re.compile(r"[0-9@]|://")
MASK = "<*>"
#: Bits of the bitmap of leaves (8 MB), and lines summed up before they are passed on.
BITS = 1 << 26
_WORD = 1 << 15
LINES_AT_ONCE = 200_000
TEXTS_AT_ONCE = 256
#: Tokens that a task takes in at once, and the most that the lines of one leaf may have for that.
TOKENS_AT_ONCE = 1 << 18
LEAF_TOKENS = 1 << 22
#: Tokens whose hashes are remembered while texts are read, none longer than so many characters.
TOKENS_KNOWN = 1 << 15
TOKEN_CHARS = 64


# --- parsing --------------------------------------------------------------------------------------


def _hash(text: str) -> int:
    """A signed 64-bit hash."""
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def _routed(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Number, leaf and tokens of every line that has tokens."""
    for at, line in enumerate(text.split("\n")):
        tokens = line.split()
        if tokens:
            lead = [MASK if FIELD.search(t) else t for t in tokens[:LEADING]]
            yield at, _hash(f"{len(tokens)} {' '.join(lead)}"), tokens


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by leaf, added up as far as memory is set aside for it; one text counts twice in a leaf
    that holds two of its lines."""
    held: dict[tuple[int, int], int] = {}

    def passed_on() -> pa.RecordBatch:
        leaves, sizes = zip(*held)
        columns = [pa.array(v, pa.int64()) for v in (leaves, sizes, list(held.values()))]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, ["leaf", "tokens", "n"])

    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
            for text in batch.column(0).slice(start, TEXTS_AT_ONCE).to_pylist():
                for _, leaf, tokens in _routed(text):
                    key = leaf, len(tokens)
                    held[key] = held.get(key, 0) + 1
            if len(held) > LINES_AT_ONCE:
                yield passed_on()
    if held:
        yield passed_on()


class _Hashes(dict):
    """32-bit hashes of tokens (fields: zero), many of them remembered."""

    def __missing__(self, token: str) -> int:
        h = 0 if FIELD.search(token) else xxhash.xxh32_intdigest(token) >> 1 or 1
        if len(token) <= TOKEN_CHARS:
            if len(self) >= TOKENS_KNOWN:
                self.clear()
            self[token] = h
        return h


LINE = "leaf long, line long, a long, b long, doc_id long, at int, tokens "


def _lines_of(bitmap: np.ndarray, packed: bool):
    """A row per line of the leaves on the bitmap, with the hashes of its tokens, packed or as an array."""
    kind = pa.binary() if packed else pa.list_(pa.int32())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = bitmap.tobytes(), _Hashes()
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                found: list[tuple] = []
                for n, text in enumerate(part.column("text").to_pylist()):
                    for at, leaf, tokens in _routed(text):
                        bit = leaf % BITS
                        if bits[bit >> 3] >> (bit & 7) & 1:
                            hashes = array("I", map(known.__getitem__, tokens))
                            found.append((n, at, leaf, _hash(" ".join(tokens)), hashes.tobytes() if packed else hashes.tolist()))
                if found:
                    owner, at, leaf, line, tokens = zip(*found)
                    own = part.take(pa.array(owner))
                    columns = [pa.array(leaf, pa.int64()), pa.array(line, pa.int64()), *[own.column(c) for c in ("a", "b", "doc_id")]]
                    columns += [pa.array(at, pa.int32()), pa.array(tokens, kind)]
                    yield pa.RecordBatch.from_arrays(columns, ["leaf", "line", "a", "b", "doc_id", "at", "tokens"])

    return read


def _words(hashes: DataFrame, column: str) -> DataFrame:
    """w and bits: the hashes on a bitmap of BITS bits, in at most BITS / _WORD rows whatever there is."""
    bit = F.pmod(F.col(column), F.lit(BITS))
    return hashes.groupBy((bit / _WORD).cast("int").alias("w")).agg(F.bitmap_construct_agg((bit % _WORD).cast("long")).alias("bits"))


def _bitmaps(counted: DataFrame, repeated: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves (leaf, tokens, n) with lines enough for a template, and those with more than ``largest`` tokens."""
    bit = F.pmod(F.col("leaf"), F.lit(BITS))
    place = (bit % _WORD).cast("long")
    chosen = counted.filter(_enough(F.col("n"), F.col("tokens"), repeated))
    words = chosen.groupBy((bit / _WORD).cast("int").alias("w")).agg(
        F.bitmap_construct_agg(place).alias("every"),
        F.bitmap_construct_agg(F.when(F.col("n") * F.col("tokens") > largest, place)).alias("large"),
    )
    out = np.zeros((2, BITS // 8), np.uint8)
    for r in words.collect():  # at most BITS / _WORD rows
        for n, name in enumerate(("every", "large")):
            out[n, r["w"] * _WORD // 8 : (r["w"] + 1) * _WORD // 8] = np.frombuffer(bytes(r[name]), np.uint8)
    return out[0] & ~out[1], out[1]


def _marked(rows: DataFrame, hashes: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``marked``: whether their hash is on the bitmap of ``hashes``, which is looked up in place."""
    words = F.broadcast(_words(hashes, column))
    bit = F.pmod(F.col(column), F.lit(BITS))
    rows = rows.withColumns({"w": (bit / _WORD).cast("int"), "at": (bit % _WORD).cast("int")})
    byte = F.conv(F.hex(F.substring("bits", F.expr("at div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, F.col("at") % 8) == 1
    found = rows.join(words, "w", "left").withColumn("marked", F.coalesce(hit, F.lit(False)))
    return found.drop("w", "at", "bits")


# --- templates, by shuffles -----------------------------------------------------------------------


def _key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b")]


def _enough(texts: Column, tokens: Column, repeated: int) -> Column:
    return (texts - 1) * tokens >= repeated


def templates(lines: DataFrame, repeated: int = REPEATED) -> DataFrame:
    """leaf, line, template and literals of distinct lines (leaf, line, texts, tokens).

    ``literals`` is the number of tokens that the template keeps. A line of which less than LITERAL
    stays literal is its own template. Counts are combined before they move, so a leaf or a value
    that most lines share is no hot spot.
    """
    each = lines.select("leaf", "line", "texts", F.size("tokens").alias("n"), F.posexplode("tokens").alias("at", "token")).filter("token <> 0")
    values = each.groupBy("leaf", "at", "token").agg(F.sum("texts").alias("held"), F.max("n").alias("n"))
    literal = values.filter(_enough(F.col("held"), F.col("n"), repeated)).select("leaf", "at", "token")
    kept = each.select("leaf", "line", "at", "token").join(literal, ["leaf", "at", "token"])
    kept = kept.groupBy("leaf", "line").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("kept"))
    whole = lines.join(kept, ["leaf", "line"], "left").withColumn("n", F.size("tokens"))
    general = F.when(F.col("kept").isNull(), F.lit(False)).otherwise(F.size("kept") >= LITERAL * F.col("n"))
    return whole.select(
        "leaf",
        "line",
        F.when(general, F.xxhash64(F.lit("template"), "kept")).otherwise(F.col("line")).alias("template"),
        F.when(general, F.size("kept")).otherwise(F.col("n")).alias("literals"),
    )


def _lost_by_shuffles(found: DataFrame, repeated: int) -> DataFrame:
    """a, b, at of the lines that go, of leaves of any size. Everything is combined before it moves."""
    found = written(found, "places")
    places = found.select("a", "b", "doc_id", "at", "leaf", "line")
    # A line once per text, with the text's smallest doc_id.
    once = places.groupBy("leaf", "line", "a", "b").agg(F.min("doc_id").alias("doc_id"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "a", "b")))
    held = once.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("texts"), first.alias("first"))
    tokens = found.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"))
    lines = written(held.join(tokens, ["leaf", "line"]), "lines")

    named = written(lines.select("leaf", "line", "texts", "first").join(templates(lines, repeated), ["leaf", "line"]), "templates")
    # Texts that hold several lines of a template count once: the sum is an upper bound, which the
    # exact count of the few templates that reach it settles.
    often = named.groupBy("leaf", "template").agg(F.sum("texts").alias("texts"), F.max("literals").alias("literals"), F.min("first").alias("first"))
    often = often.filter(_enough(F.col("texts"), F.col("literals"), repeated) & F.col("first").isNotNull())
    candidates = named.select("leaf", "line", "template").join(often.select("leaf", "template", "literals", "first"), ["leaf", "template"])
    holders = once.select("leaf", "line", "a", "b").join(candidates.select("leaf", "line", "template", "literals"), ["leaf", "line"])
    exact = holders.groupBy("leaf", "template", "a", "b").agg(F.max("literals").alias("literals"))
    exact = exact.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("texts"), F.max("literals").alias("literals"))
    gone = exact.filter(_enough(F.col("texts"), F.col("literals"), repeated)).select("leaf", "template")
    gone = candidates.join(gone, ["leaf", "template"]).select("leaf", "line", "first")

    lost = places.join(gone, ["leaf", "line"]).filter((F.col("a") != F.col("first.a")) | (F.col("b") != F.col("first.b")))
    return lost.select("a", "b", "at")


# --- templates, many leaves in a task -------------------------------------------------------------


def _numbered(*columns: np.ndarray) -> np.ndarray:
    """A number for each row, in the order of the columns; equal exactly where all columns are."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _first_of(number: np.ndarray, *order_by: np.ndarray) -> np.ndarray:
    """For each number, the row that comes first by the given columns."""
    order = np.lexsort((*order_by[::-1], number))
    return order[np.r_[True, number[order[1:]] != number[order[:-1]]]]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _kept(leaf: np.ndarray, texts: np.ndarray, tokens: list[bytes], repeated: int) -> tuple[np.ndarray, ...]:
    """Of distinct lines, by their leaves' numbers: how many tokens they have, how many values of them
    recur enough to stay literal, and two 64-bit hashes of those and their places."""
    flat = np.frombuffer(b"".join(tokens), np.uint32)
    n = np.array([len(t) // 4 for t in tokens], np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    longest = np.zeros(leaf[-1] + 1, np.int64)
    np.maximum.at(longest, leaf, n)
    base = np.cumsum(longest) - longest
    literal = flat != 0
    owner, value = owner[literal], ((base[leaf[owner]] + at).astype(np.uint64) << np.uint64(32) | flat)[literal]
    _, which = np.unique(value, return_inverse=True)
    held = np.bincount(which, weights=texts[owner])[which] if len(which) else np.zeros(0)
    often = (held - 1) * n[owner] >= repeated
    owner, value = owner[often], value[often]
    size = np.bincount(owner, minlength=len(n))
    names = np.zeros((2, len(n)), np.uint64)
    if len(owner):
        begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for i, salt in enumerate((0, 0x9E3779B97F4A7C15)):
            names[i, owner[begin]] = np.add.reduceat(_mixed(value + np.uint64(salt)), begin)
    return n, size, *names.view(np.int64)


def _lost(rows: pa.Table, repeated: int) -> pa.RecordBatch:
    """a, b, at of the lines that go, out of all lines of some leaves."""
    leaf, line, a, b, at = (rows.column(c).to_numpy() for c in ("leaf", "line", "a", "b", "at"))
    nameless = rows.column("doc_id").is_null().to_numpy()
    doc = pc.fill_null(rows.column("doc_id"), 0).to_numpy()
    leaf, text = _numbered(leaf), _numbered(a, b)
    own = _numbered(leaf, line)
    # A line once per text, with the text's smallest doc_id.
    once = _first_of(_numbered(own, text), nameless, doc)
    one = _first_of(own)
    texts = np.bincount(own[once])
    n, size, name, name2 = _kept(leaf[one], texts, rows.column("tokens").take(pa.array(one)).to_pylist(), repeated)
    general = (size > 0) & (size >= LITERAL * n)
    template = _numbered(leaf[one], general, np.where(general, name, line[one]), np.where(general, name2, 0))
    literals = np.zeros(len(one), np.int64)
    literals[template] = np.where(general, size, n)

    of = template[own[once]]
    holders = np.bincount(of[_first_of(_numbered(of, text[once]))], minlength=len(one))
    first = _first_of(of, nameless[once], doc[once], text[once])
    keeper, known = np.zeros(len(one), np.int64), np.zeros(len(one), bool)
    keeper[of[first]], known[of[first]] = text[once][first], ~nameless[once][first]
    gone = known & ((holders - 1) * literals >= repeated)

    mine = template[own]
    lost = np.flatnonzero(gone[mine] & (text != keeper[mine]))
    lost = lost[_first_of(_numbered(text[lost], at[lost]))] if len(lost) else lost
    return pa.RecordBatch.from_arrays([pa.array(a[lost]), pa.array(b[lost]), pa.array(at[lost], pa.int32())], ["a", "b", "at"])


def _lost_by_leaf(repeated: int):
    """Lines sorted by leaf to those that go; whole leaves are held, as many as make up a chunk."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, TOKENS_AT_ONCE
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.column("tokens").nbytes // 4
            if size >= limit:
                rows = pa.Table.from_batches(held).combine_chunks()
                leaf = rows.column("leaf").to_numpy()
                cut = int(np.searchsorted(leaf, leaf[-1]))
                if cut:
                    yield _lost(rows.slice(0, cut), repeated)
                held = rows.slice(cut).to_batches()
                size = sum(b.column("tokens").nbytes // 4 for b in held)
                limit = max(TOKENS_AT_ONCE, 2 * size)
        if held:
            yield _lost(pa.Table.from_batches(held).combine_chunks(), repeated)

    return read


def recurring(docs: DataFrame, repeated: int = REPEATED, largest: int = LEAF_TOKENS) -> DataFrame:
    """a, b (a text's hashes) and drop, the numbers of its lines that go, for texts that lose any.

    Equal texts count once and are treated alike. A template stays in the text whose smallest
    doc_id is the smallest of all; only texts without doc_id hold it: nothing goes. Leaves of up to
    ``largest`` tokens are settled in one task each, larger ones by shuffles, with the same result.
    """
    spark = docs.sparkSession
    importable(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.select("text").mapInArrow(_leaves, "leaf long, tokens long, n long")
    counted = counted.groupBy("leaf", "tokens").agg(F.sum("n").alias("n"))
    # A leaf with too few lines for any template is left out.
    usual, large = _bitmaps(counted, repeated, largest)
    texts = texts.select(*_key(F.col("text")), "doc_id", "text")
    rows = texts.mapInArrow(_lines_of(usual, True), LINE + "binary")
    lost = rows.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(_lost_by_leaf(repeated), "a long, b long, at int")
    if large.any():
        found = texts.mapInArrow(_lines_of(large, False), LINE + "array<int>")
        lost = lost.unionByName(_lost_by_shuffles(found, repeated))
    return lost.groupBy("a", "b").agg(F.collect_set("at").alias("drop"))


# --- documents ------------------------------------------------------------------------------------


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _cut(docs: DataFrame, repeated: int, largest: int) -> tuple[DataFrame, list[Column]]:
    """Rows with their boilerplate gone, and the columns of ``docs`` on them.

    Only rows whose text may lose lines move, to meet what goes; a bitmap of fixed size tells them.
    """
    drop = written(recurring(docs.select("doc_id", "text"), repeated, largest), "drop")
    others = [c for c in docs.columns if c != "text"]
    inner = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    packed = docs.select(inner.alias("__row"), F.col("text").alias("__text"), *_key(F.col("text")))
    packed = _marked(packed, drop.select("a"), "a")
    moved = packed.filter("marked").join(drop, ["a", "b"], "left")
    whole = packed.filter("NOT marked").withColumn("drop", F.lit(None).cast("array<int>"))
    met = moved.unionByName(whole)
    left = F.filter(_lines(F.col("__text")), lambda line, i: ~F.array_contains(F.col("drop"), i))
    text = F.when(F.col("drop").isNull(), F.col("__text")).otherwise(F.array_join(left, "\n"))
    cut = met.withColumn("__left", text)
    own = {c: F.col("__left") if c == "text" else F.col(f"__row.c{others.index(c)}") for c in docs.columns}
    if "n_chars" in own:
        chars = F.when(F.col("drop").isNull(), own["n_chars"]).otherwise(F.length("__left"))
        own["n_chars"] = chars.cast(docs.schema["n_chars"].dataType)
    return cut, [column.alias(c) for c, column in own.items()]


def stripped(docs: DataFrame, repeated: int = REPEATED, largest: int = LEAF_TOKENS) -> DataFrame:
    """doc_id and ``text`` rid of boilerplate lines of every row of ``docs``, n_lines and n_dropped.

    Defined results: a null text stays null; a text all of boilerplate becomes empty; blank lines
    stay; a null doc_id is no obstacle, but its text is never the one in which a template stays;
    repeated rows and equal texts are treated alike; an empty table gives an empty table. Other
    columns are left out.
    """
    cut, columns = _cut(docs.select("doc_id", "text"), repeated, largest)
    dropped = F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop"))
    return cut.select(*columns, F.size(_lines(F.col("__text"))).cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"))


def clean(docs: DataFrame, repeated: int = REPEATED, largest: int = LEAF_TOKENS) -> DataFrame:
    """All rows of ``docs`` with exactly their columns, without boilerplate lines; results as in ``stripped``.

    n_chars, if there, follows the text of rows that lose lines.
    """
    cut, columns = _cut(docs, repeated, largest)
    return cut.select(*columns)

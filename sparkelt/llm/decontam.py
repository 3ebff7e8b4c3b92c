"""Benchmark decontamination by template windows with typed slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import let, window_hashes

WINDOW = 8
#: Literal words that a benchmark window needs beside its slots.
MIN_LITERALS = 5
#: A document is contaminated by an item when so large a share of the item's windows is found, or
#: so many of them (WINDOW + MIN_RUN - 1 words).
MIN_COVERAGE = 0.5
MIN_RUN = 6
#: Up to so many benchmark windows are looked up where text windows arise, up to so many (some
#: 100 MB) are broadcast to the join; beyond that the join shuffles. The rows are the same.
LOOKED_UP_WINDOWS = 20_000
BROADCAST_WINDOWS = 400_000

#: Units of measure and currency that stand for a slot of their own. Fixed values.
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hrs hour hours day days week weeks "
    "month months year years minute minutes second seconds meter meters metre metres kilometer "
    "kilometers kilometre kilometres mile miles inch inches foot feet yard yards gram grams "
    "kilogram kilograms pound pounds ounce ounces liter liters litre litres dollar dollars euro "
    "euros cent cents usd eur gbp percent degree degrees mph kmh"
).split()
#: Words for numbers, which stand for the same slot as digits. Fixed values.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion dozen"
).split()
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"

#: Marks put before a capitalised word within a sentence, and in place of a decimal separator.
CAPITAL, POINT = "\x01", "\x03"
TOKEN = rf"[\p{{L}}\p{{M}}\p{{N}}{CAPITAL}{POINT}]+"


def tokens(text: Column) -> Column:
    """Lower-case words and numbers; a capitalised word within a sentence keeps a mark."""
    plain = F.translate(F.coalesce(text, F.lit("")), CAPITAL + POINT, "  ")
    named = F.regexp_replace(plain, r"(?<=[^.!?:;\s]\s)(?=\p{Lu}\p{Ll})", CAPITAL)
    joined = F.regexp_replace(named, "(?<=[0-9])[.,](?=[0-9])", POINT)
    return F.regexp_extract_all(F.lower(joined), F.lit(f"({TOKEN})"), F.lit(1))


def canonical(words: Column) -> Column:
    """The tokens with numbers, names and units as typed placeholders."""

    def slot(w: Column) -> Column:
        first = F.substring(w, 1, 1)
        return (
            F.when(first == CAPITAL, NAME)
            .when(first.between("0", "9") | w.isin(NUMBER_WORDS), NUMBER)
            .when(w.isin(UNITS), UNIT)
            .otherwise(w)
        )

    return F.transform(words, slot)


def _is_slot(w: Column) -> Column:
    return F.substring(w, 1, 1) == "<"


def item_windows(benchmark: DataFrame, size: int = WINDOW, literals: int = MIN_LITERALS) -> DataFrame:
    """Every window of every item: item_id, at, n (windows of the item), w, template and slots (words).

    Items shorter than a window are one window of their own length. A window with too few literal
    words would match any text of its shape, so it is compared along the item, to the right and then
    to the left, until it holds enough: wide, from ``before`` words ahead of it, and wide_slots. told
    says that it does; if the whole item does not, the window counts with the item's own words only.

    The first word of an item carries the mark of a name if it follows other words in a text, never
    in the item. Windows that reach it come in both forms;
    told_same says whether the marked form is told when the text has the item's own word there.
    """
    bare = tokens(F.col("text"))
    capital = F.coalesce("text", F.lit("")).rlike(r"^[^\p{L}\p{M}\p{N}]*\p{Lu}\p{Ll}")
    worded = benchmark.select("item_id", bare.alias("bare"), capital.alias("capital")).filter(F.size("bare") > 0)
    first = F.concat(F.lit(CAPITAL), F.element_at("bare", 1))
    marked = F.concat(F.array(first), F.slice("bare", 2, F.size("bare")))
    forms = F.when(F.col("capital"), F.array(F.col("bare"), marked)).otherwise(F.array(F.col("bare")))
    formed = worded.select("item_id", F.posexplode(forms).alias("form", "words"), F.col("bare"))
    sized = formed.select(
        "item_id",
        (F.col("form") == 1).alias("marked"),
        "words",
        canonical(F.col("words")).alias("canon"),
        _literal_places(canonical(F.col("words"))).alias("told_at"),
        _literal_places(canonical(F.col("bare"))).alias("bare_at"),
        F.size("words").alias("long"),
        F.least(F.lit(size), F.size("words")).alias("w"),
    )
    need = F.least(F.lit(literals), F.col("w"))
    cut = sized.withColumn("n", (F.col("long") - F.col("w") + 1).cast("long")).select(
        "*", need.alias("need"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("begin")
    )
    last = F.col("begin") + F.col("w") - 1
    ahead = F.size(F.filter("bare_at", lambda x: x < F.col("begin")))
    to = F.coalesce(F.get("bare_at", ahead + F.col("need") - 1), F.col("long"))
    back = F.get("bare_at", F.size("bare_at") - F.col("need"))
    short = F.size("bare_at") - ahead < F.col("need")
    reach = cut.select(
        "*",
        F.when(F.size("bare_at") < F.col("need"), F.col("begin")).when(short, F.least("begin", back)).otherwise(F.col("begin")).alias("low"),
        F.when(F.size("bare_at") < F.col("need"), last).otherwise(F.greatest(last, to)).alias("high"),
    )

    def enough(places: str) -> Column:
        return F.size(F.filter(places, lambda x: x.between(F.col("low"), F.col("high")))) >= F.col("need")

    length = F.col("high") - F.col("low") + 1
    return reach.filter(~F.col("marked") | (F.col("low") == 1)).select(
        "item_id",
        F.col("begin").alias("at"),
        "n",
        "w",
        F.slice("canon", F.col("begin"), F.col("w")).alias("template"),
        F.slice("words", F.col("begin"), F.col("w")).alias("slots"),
        (F.col("begin") - F.col("low")).alias("before"),
        F.slice("canon", F.col("low"), length).alias("wide"),
        F.slice("words", F.col("low"), length).alias("wide_slots"),
        enough("told_at").alias("told"),
        (F.col("marked") & enough("bare_at")).alias("told_same"),
    )


def _literal_places(canon: Column) -> Column:
    """The places, from one, of the literal words."""
    numbered = F.transform(canon, lambda w, i: F.when(~_is_slot(w), i + 1))
    return F.filter(numbered, lambda i: i.isNotNull())


def _hash(template: Column, size: int) -> Column:
    return F.xxhash64(*[F.xxhash64(F.get(template, F.lit(i))) for i in range(size)])


def matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Contaminated documents: one row per document row and item that its text holds.

    Columns: doc_id, row (tells repeated rows apart), item_id, n_windows (distinct item windows
    found), coverage, exact (all slots as in the item) and the first and last word. Windows meet
    by the hash of their template, then by the template itself. A window whose slots differ from the
    item's counts only if each of its slot values stands for one value along the diagonal; one that
    holds the item's own words always counts.

    The item windows come from the benchmark, never from the corpus. Their number is counted; a
    small set is broadcast, a large one joins by shuffle. Only hits are shuffled after that, by
    document row. Defined results: null or empty texts hold nothing; a null doc_id stays; repeated
    rows are matched each; benchmark rows of equal item_id, null included, are one item in several versions:
    a place counts once, whichever version's window stands there, and coverage is of the longest
    version of which the text holds a window;
    empty tables give an empty table; other columns are ignored.
    """
    items = item_windows(benchmark, size).persist()
    try:
        shape = {
            r["w"]: r
            for r in items.groupBy("w")
            .agg(F.count("*").alias("n"), F.max("before").alias("before"), F.max(F.size("wide") - F.col("before")).alias("ahead"))
            .collect()
        }
        total = sum(r["n"] for r in shape.values())
        known = {
            w: [r["h"] for r in items.filter(F.col("w") == w).select(_hash(F.col("template"), w).alias("h")).distinct().collect()]
            if total <= LOOKED_UP_WINDOWS
            else None
            for w in shape
        }
    finally:
        items.unpersist()
    worded = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), tokens(F.col("text")).alias("words"))
    worded = worded.withColumn("canon", canonical(F.col("words")))
    hits = None
    for w in sorted(shape) or [size]:
        part = _hits(worded, items.filter(F.col("w") == w), w, known.get(w), total <= BROADCAST_WINDOWS, shape.get(w))
        hits = part if hits is None else hits.unionByName(part)
    return _judged(hits)


def _hits(worded: DataFrame, items: DataFrame, w: int, known: list[int] | None, small: bool, reach: Row | None) -> DataFrame:
    """Windows of the texts that an item's stand in, as a template or word by word, with the slot values of both."""
    numbered = F.transform(window_hashes(F.col("canon"), w), lambda h, i: F.struct(i.alias("pos"), h.alias("h")))
    if known is not None:
        numbered = F.filter(numbered, lambda x: x["h"].isin(known)) if known else F.filter(numbered, lambda x: F.lit(False))
    before, ahead = (reach["before"], reach["ahead"]) if reach else (0, w)

    def around(words: str, pos: Column) -> Column:
        low = F.greatest(pos - before, F.lit(0))
        return F.slice(words, low + 1, pos + ahead - low)

    cut = F.transform(
        numbered,
        lambda x: F.struct(
            x["pos"],
            x["h"],
            F.least(x["pos"], F.lit(before)).alias("ahead_of"),
            around("canon", x["pos"]).alias("near_template"),
            around("words", x["pos"]).alias("near"),
        ),
    )
    cut = worded.withColumn("found", cut).select("doc_id", "row", F.inline("found"))
    items = items.withColumn("h", _hash(F.col("template"), w))
    met = cut.join(F.broadcast(items) if small else items, "h")
    met = met.filter(F.slice("near_template", F.col("ahead_of") + 1, w) == F.col("template"))
    met = met.withColumn("own", F.slice("near", F.col("ahead_of") + 1, w)).withColumn("same", F.col("own") == F.col("slots"))
    start, length = F.col("ahead_of") - F.col("before") + 1, F.size("wide")
    met = met.withColumn("inside", F.col("ahead_of") >= F.col("before"))
    met = met.withColumn("wide_own", F.when(F.col("inside"), F.slice("near", F.greatest(start, F.lit(1)), length)))
    alike = F.col("inside") & (F.slice("near_template", F.greatest(start, F.lit(1)), length) == F.col("wide"))
    told = F.col("told") | (F.col("told_same") & (F.get("wide_own", F.lit(0)) == F.get("wide_slots", F.lit(0))))
    met = met.filter(F.col("same") | (alike & told))

    def values(template: str, item: str, own: str) -> Column:
        zipped = F.zip_with(template, F.arrays_zip(F.col(item).alias("item"), F.col(own).alias("own")), lambda t, v: F.struct(t.alias("t"), v["item"].alias("item"), v["own"].alias("own")))
        return F.transform(F.filter(zipped, lambda x: _is_slot(x["t"])), lambda x: F.struct(x["item"], x["own"]))

    return met.select(
        "doc_id",
        "row",
        "item_id",
        "at",
        "n",
        "pos",
        F.lit(w).alias("w"),
        F.when(F.col("same"), values("template", "slots", "own")).otherwise(values("wide", "wide_slots", "wide_own")).alias("values"),
    )


def _judged(hits: DataFrame) -> DataFrame:
    diagonals = (
        hits.repartition("row")
        .groupBy("row", "item_id", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("n").alias("n"),
            F.max("w").alias("w"),
            F.collect_set(F.struct("at", "values")).alias("found"),
            F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"),
        )
    )

    def torn(values: Column) -> Column:
        """Values of the item that stand for more than one in the text."""
        items = F.transform(values, lambda v: v["item"])
        return F.filter(F.array_distinct(items), lambda x: F.size(F.filter(items, lambda y: y == x)) > 1)

    # A window counts with the item's own words, or if none of its values stands for two.
    held = let(
        torn(F.col("values")),
        lambda bad: F.filter(
            "found",
            lambda f: F.forall(f["values"], lambda v: v["item"] == v["own"])
            | F.forall(f["values"], lambda v: ~F.array_contains(bad, v["item"])),
        ),
    )
    kept = diagonals.withColumn("held", F.array_distinct(F.transform(held, lambda f: f["at"]))).filter(F.size("held") > 0)
    spans = kept.groupBy("row", "item_id").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n").alias("n"),
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).cast("long").alias("n_windows"),
        F.max(F.size("held")).alias("run"),
        F.bool_and(F.forall("values", lambda v: v["item"] == v["own"])).alias("exact"),
        F.min(F.array_min("held") + F.col("diagonal")).cast("long").alias("first_word"),
        F.max(F.array_max("held") + F.col("diagonal") + F.col("w") - 1).cast("long").alias("last_word"),
    )
    return (
        spans.withColumn("coverage", F.col("n_windows") / F.col("n"))
        .filter((F.col("coverage") >= MIN_COVERAGE) | (F.col("run") >= MIN_RUN))
        .select("doc_id", "row", "item_id", "n_windows", "coverage", "exact", "first_word", "last_word")
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with exactly their own columns.

    Contamination depends on the text alone, so rows are told apart by two hashes of it; a text
    that many rows share meets one row in the join.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b")).alias("doc_id")
    bad = matches(docs.select(key, "text"), benchmark, size).select("doc_id").distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("whole"), key)
    kept = packed.join(bad, "doc_id", "left_anti")
    return kept.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])

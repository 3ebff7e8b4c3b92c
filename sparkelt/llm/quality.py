"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, let, window_hashes, words_of

SYMBOL = "[#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]"
WINDOW = 5

#: Frequent short words of the four languages served. Fixed values.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on are this at from or an "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un une du est que qui dans pour par sur pas au "
    "el los las y del se no por con su para es lo como más"
).split()
STOP_WORDS = sorted({s for w in STOP_WORDS for s in (w, w.capitalize())})


@dataclass(frozen=True)
class Rule:
    """A document of ``min_words`` or more fails if the measure lies outside [low, high].

    ``base`` rules are contractual.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    base: bool = False
    min_words: int = 0


#: The measures are columns of ``measures``; the bounds are inclusive.
RULES = (
    Rule("too_few_words", "n_words", low=10, base=True),
    Rule("repeated_words", "repeat_percent", high=20, base=True),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("upper_case", "upper_share", high=0.5),
    Rule("exclamations", "marks_per_word", high=0.5),
    Rule("duplicate_lines", "dup_line_share", high=0.5),
    Rule("long_words", "mean_word_chars", low=1.5, high=30.0),
    Rule("few_stop_words", "stop_word_share", low=0.005, min_words=50),
)


def _repeat_words(words: Column) -> Column:
    """Words lying in a window of five that occurs at least twice in the text."""

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeated(pairs: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before = F.get(pairs, i - 1)["h"] == x["h"]
            after = F.get(pairs, i + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["i"]))

    def count(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(let(pairs, repeated), covered)
        )

    return let(window_hashes(words, WINDOW), count)


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: F.struct(F.size(a).alias("lines"), (F.size(a) - F.size(F.array_distinct(a))).alias("dup")))


def measures(docs: DataFrame, number: Column | None = None) -> DataFrame:
    """The rows of ``docs`` with all that the rules are stated in, and ``number`` as __at."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def only(pattern: str, within: Column) -> Column:
        return F.length(F.regexp_replace(within, f"[^{pattern[1:-1]}]+", ""))

    marks = let(
        F.regexp_replace(text, f"[^{SYMBOL[1:-1]}!A-Z]+", ""),
        lambda m: F.struct(
            only(SYMBOL, m).alias("symbols"), only("[A-Z]", m).alias("upper"), only("[!]", m).alias("bang")
        ),
    )
    by_words = let(
        words_of(F.col("text"), WHITE_SPACE),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop"),
        ),
    )
    own = {"__w": by_words, "__l": _dup_lines(text), "__m": marks}
    counted = docs.withColumns(own if number is None else own | {"__at": number}).withColumns(
        {
            "n_words": F.col("__w.n_words"),
            "word_chars": (F.length(text) - only(SPACE, text)).cast("long"),
            "n_symbols": F.col("__m.symbols").cast("long"),
            "n_dup_lines": F.col("__l.dup").cast("long"),
            "n_repeat_words": F.col("__w.n_repeat_words"),
            "__lines": F.col("__l.lines"),
            "__stop": F.col("__w.n_stop"),
            "__upper": F.col("__m.upper"),
            "__marks": F.col("__m.bang"),
        }
    )

    def per(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    n = F.col("n_words")
    return counted.withColumns(
        {
            "repeat_percent": per(100 * F.col("n_repeat_words"), n),
            "symbols_per_word": per(F.col("n_symbols"), n),
            "marks_per_word": per(F.col("__marks"), n),
            "upper_share": per(F.col("__upper"), F.col("word_chars")),
            "dup_line_share": per(F.col("n_dup_lines"), F.col("__lines")),
            "mean_word_chars": per(F.col("word_chars"), n),
            "stop_word_share": per(F.col("__stop"), n),
        }
    ).drop("__w", "__l", "__m", "__lines", "__stop", "__upper", "__marks")


def verdict(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """base_failed, kept and the names of the failed rules, as columns over ``measures``."""

    def fails(rule: Rule) -> Column:
        out = F.lit(False)
        if rule.low is not None:
            out = out | (F.col(rule.measure) < rule.low)
        if rule.high is not None:
            out = out | (F.col(rule.measure) > rule.high)
        return out & (F.col("n_words") >= rule.min_words)

    base = F.lit(False)
    for rule in rules:
        base = base | fails(rule) if rule.base else base
    failed = F.array_compact(F.array(*[F.when(fails(r), F.lit(r.name)) for r in rules]))
    return {
        "base_failed": base,
        "kept": F.size(failed) == 0,
        "failed_rules": F.array_join(failed, ","),
    }


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its measures and verdict; other columns are left out.

    Defined results: a null text counts as empty and, like every text of fewer than ten words,
    fails; a null doc_id stays null; repeated rows are judged each on its own; an empty table gives
    an empty table. No shuffle and no Python: one scan, one projection.
    """
    return measures(docs.select("doc_id", "text")).withColumns(verdict(rules)).drop("text")


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with exactly their own columns."""
    inner = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    packed = docs.select(F.col("doc_id"), F.col("text"), inner.alias("__row"))
    # A filter is not pushed below a row number. Pushed further, it would repeat the measures in its
    # condition, once for every rule.
    numbered = measures(packed, F.monotonically_increasing_id()).withColumns(verdict(rules))
    passed = numbered.filter(F.col("kept") & (F.col("__at") >= 0))
    return passed.select(*[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(docs.columns)])

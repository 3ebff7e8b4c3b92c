"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Everything per document is a column expression. Only counts by vote and feature pattern reach the
driver; their number is bounded by the number of patterns, whatever the size of the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, written

#: Base patterns. Fixed values, written with possessive quantifiers and look-behinds where those
#: change nothing but the time on long texts: a match can only begin where a run of its first
#: characters begins, or where the previous match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A space or hyphen between digits becomes this character, so that a card is a run of one class
#: (a repeated group would recurse once per digit).
JOINT = "\x01"
CARD = rf"[0-9{JOINT}]{{2,}}"

#: Candidates beyond the base kinds, told apart by their shape.
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
SECRET = r"[A-Za-z0-9+/_=-]{12,}+"
CANDIDATE = f"{NATIONAL_ID}|{LOCAL_PHONE}|{SECRET}"

#: Cues and known openings. Fixed values.
CUES = "password passwd pwd secret token credential api key ssn social tel phone call fax contact"
OPENINGS = "AKIA ASIA ghp_ gho_ xox sk- password= passwd= pwd= token= secret= api_key= key="
CONTEXT_CHARS = 40

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("id", "local_phone", "secret")
SPAN = "array<struct<kind:string,start:int,end:int,text:string>>"


def _places(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their code-point positions.

    The lengths of what stands between the matches add up to where each begins.
    """

    def located(x: Column) -> Column:
        steps = F.zip_with(
            F.slice(x["between"], 1, F.size(x["found"])),
            x["found"],
            lambda b, m: F.struct(F.length(b).alias("skip"), m.alias("text")),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            begin = acc["at"] + s["skip"]
            end = begin + F.length(s["text"])
            one = F.array(F.struct(begin.alias("start"), end.alias("end"), s["text"].alias("text")))
            return F.struct(end.alias("at"), F.concat(acc["out"], one).alias("out"))

        return F.aggregate(steps, start, step, lambda acc: acc["out"])

    both = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
    )
    return let(both, located)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    ints = F.transform(
        F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), lambda c: c.cast("int")
    )
    doubled = F.transform(
        ints, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def _none() -> Column:
    return F.array().cast(SPAN)


def _kind(kind: str, places: Column) -> Column:
    return F.transform(
        places, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"], x["end"], x["text"])
    ).cast(SPAN)


def base_spans(text: Column) -> Column:
    """All base spans of a text, by kind as listed, then by start."""
    digit = text.rlike("[0-9]")
    joined = F.regexp_replace(F.translate(text, JOINT, "\x02"), "(?<=[0-9])[ -](?=[0-9])", JOINT)

    def card(x: Column) -> Column:
        return let(_digits(x["text"]), lambda d: F.length(d).between(13, 19) & _luhn(d))

    email = F.when(text.contains("@"), _kind("email", _places(text, EMAIL))).otherwise(_none())
    ip = F.filter(_places(text, IP), lambda x: x["text"].rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"))
    cards = F.transform(
        F.filter(_places(joined, CARD), card),
        lambda x: F.struct(x["start"], x["end"], F.substr(text, x["start"] + 1, x["end"] - x["start"]).alias("text")),
    )
    phone = F.filter(_places(text, PHONE), lambda x: F.length(_digits(x["text"])).between(9, 15))
    phones = F.when(text.contains("+"), _kind("phone", phone)).otherwise(_none())
    numeric = F.when(digit, F.concat(_kind("ip", ip), _kind("card", cards), phones)).otherwise(_none())
    return F.concat(email, numeric)


# --- votes and features of the candidates ---------------------------------------------------------

LABELERS = ("shape", "gazetteer", "context", "mixed", "wordlike")
FEATURES = ("upper", "lower", "digits", "length", "equals", "cue", "shape_kind")


def _any_of(words: str, glue: str = "|") -> str:
    return glue.join(w.replace("-", r"\-") for w in words.split())


def _candidates(text: Column, base: Column) -> Column:
    """Candidate spans outside all base spans, each with its votes (1 yes, -1 no, 0 silent)."""

    def judged(x: Column) -> Column:
        t = x["text"]
        before = F.lower(F.substr(text, F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT_CHARS))))
        is_id = t.rlike(f"^{NATIONAL_ID}$")
        is_phone = t.rlike(f"^{LOCAL_PHONE}$")
        letters = F.length(F.regexp_replace(t, "[^A-Za-z]", ""))
        digits = F.length(_digits(t))
        # Changes between letter and digit: a readable word has one at most.
        turns = F.size(F.regexp_extract_all(t, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), F.lit(0)))
        shaped = t.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|[0-9a-f]{16,}$") | is_id | is_phone
        cued = F.concat(before, F.lit(" "), F.lower(t)).rlike(f"(?<![a-z])(?:{_any_of(CUES)})(?![a-z])")
        no, yes, silent = F.lit(-1), F.lit(1), F.lit(0)
        votes = (
            F.when(shaped, yes).otherwise(silent).alias("shape"),
            F.when(t.rlike(f"^(?:{_any_of(OPENINGS)})"), yes).otherwise(silent).alias("gazetteer"),
            F.when(cued, yes).otherwise(silent).alias("context"),
            F.when(turns >= 3, yes).when((turns <= 1) & ~is_id & ~is_phone, no).otherwise(silent).alias("mixed"),
            F.when(t.rlike("/.*/") | (letters >= 0.85 * F.length(t)), no).otherwise(silent).alias("wordlike"),
        )
        features = (
            t.rlike("[A-Z]").cast("int").alias("upper"),
            t.rlike("[a-z]").cast("int").alias("lower"),
            F.floor(F.least(F.lit(3), 4 * digits / F.length(t))).cast("int").alias("digits"),
            F.floor(F.least(F.lit(3), (F.length(t) - 9) / 6)).cast("int").alias("length"),
            t.contains("=").cast("int").alias("equals"),
            cued.cast("int").alias("cue"),
            F.when(is_id | is_phone, 1).otherwise(0).alias("shape_kind"),
        )
        kind = F.when(is_id, "id").when(is_phone, "local_phone").otherwise("secret").alias("kind")
        return F.struct(kind, x["start"], x["end"], t.alias("text"), *votes, *features)

    free = F.filter(
        _places(text, CANDIDATE),
        lambda x: x["text"].rlike("[0-9]")
        & (x["text"].rlike("[A-Za-z]") | x["text"].rlike(f"^(?:{NATIONAL_ID}|{LOCAL_PHONE})$"))
        & ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    none = F.transform(F.filter(_places(F.lit(""), "x"), lambda x: F.lit(False)), judged)
    return F.when(text.rlike("[0-9]"), F.transform(free, judged)).otherwise(none)


def annotated(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and voted candidates of every row; no shuffle."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    based = docs.select("doc_id", text).withColumn("base", base_spans(F.col("text")))
    return based.select("doc_id", "base", _candidates(F.col("text"), F.col("base")).alias("candidates"))


# --- what is learnt from all candidates -----------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Labeler reliabilities, and the weights of the span classifier by feature value."""

    reliability: dict[str, float]
    bias: float
    weights: dict[tuple[str, int], float]


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def label_posteriors(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 30):
    """EM of a two-class model with independent labelers; (posterior by pattern, reliability).

    ``patterns`` are votes and how often they occur. Each labeler has its own chance of every vote
    under either class. The start is the majority of votes.
    """
    post = {v: _sigmoid(2.0 * sum(v) - 0.5) for v, _ in patterns}
    chance: dict[tuple[int, int, int], float] = {}
    for _ in range(rounds):
        mass = [1e-9, 1e-9]
        seen = {(n, c, x): 0.5 for n in range(len(LABELERS)) for c in (0, 1) for x in (-1, 0, 1)}
        for votes, count in patterns:
            for c, p in ((1, post[votes]), (0, 1 - post[votes])):
                mass[c] += count * p
                for n, x in enumerate(votes):
                    seen[n, c, x] += count * p
        chance = {(n, c, x): s / (mass[c] + 1.5) for (n, c, x), s in seen.items()}
        prior = (mass[1] + 1) / (mass[0] + mass[1] + 2)
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior))
            odds += sum(math.log(chance[n, 1, x] / chance[n, 0, x]) for n, x in enumerate(votes))
            post[votes] = _sigmoid(odds)
    right = {}
    for n, name in enumerate(LABELERS):
        good = chance.get((n, 1, 1), 0.0) + chance.get((n, 0, -1), 0.0)
        bad = chance.get((n, 1, -1), 0.0) + chance.get((n, 0, 1), 0.0)
        right[name] = good / (good + bad) if good + bad else 0.5
    return post, right


def span_classifier(rows: list[tuple[tuple[int, ...], float, int]], rounds: int = 400):
    """Logistic regression on one-hot features with soft labels, by gradient descent on counts."""
    bias, weights = 0.0, {(f, v): 0.0 for x, _, _ in rows for f, v in zip(FEATURES, x)}
    total = sum(n for _, _, n in rows) or 1
    for _ in range(rounds):
        step_b, step = 0.0, {k: 0.001 * w for k, w in weights.items()}
        for x, target, n in rows:
            z = bias + sum(weights[f, v] for f, v in zip(FEATURES, x))
            g = (_sigmoid(z) - target) * n / total
            step_b += g
            for f, v in zip(FEATURES, x):
                step[f, v] += g
        bias -= 2.0 * step_b
        weights = {k: w - 2.0 * step[k] for k, w in weights.items()}
    return bias, weights


def fit(found: DataFrame) -> Model:
    """Learns from every candidate of ``annotated`` rows."""
    counts = (
        found.select(F.explode("candidates").alias("c"))
        .groupBy(*[F.col(f"c.{n}").alias(n) for n in (*LABELERS, *FEATURES)])
        .count()
        .collect()
    )
    by_votes: dict[tuple[int, ...], int] = {}
    for r in counts:
        votes = tuple(r[n] for n in LABELERS)
        by_votes[votes] = by_votes.get(votes, 0) + r["count"]
    post, reliability = label_posteriors(sorted(by_votes.items()))
    rows = sorted(
        (tuple(r[f] for f in FEATURES), post[tuple(r[n] for n in LABELERS)], r["count"]) for r in counts
    )
    bias, weights = span_classifier(rows)
    return Model(reliability, bias, weights)


def classified(found: DataFrame, model: Model) -> DataFrame:
    """doc_id, base spans and the candidates that the classifier accepts, as ``spans``."""

    def accepted(c: Column) -> Column:
        z = F.lit(model.bias)
        for name in FEATURES:
            own = [(v, w) for (f, v), w in model.weights.items() if f == name]
            part = F.lit(0.0)
            for v, w in own:
                part = F.when(c[name] == v, F.lit(w)).otherwise(part)
            z = z + part
        return z > 0

    plain = F.transform(
        F.filter("candidates", accepted),
        lambda c: F.struct(c["kind"], c["start"], c["end"], c["text"]),
    ).cast(SPAN)

    def of(kind: str, spans: Column) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    added = let(plain, lambda p: F.concat(*[of(kind, p) for kind in ADDED_KINDS]))
    return found.select("doc_id", "base", F.concat("base", added).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, base (the base spans) and spans (those and the method's) of every row of ``docs``.

    Defined results: a null text counts as empty and has no spans; a null doc_id stays; repeated
    rows get a row each; an empty table gives an empty table; without candidates the classifier
    accepts nothing. Columns other than doc_id and text are ignored. The one heavy pass over the
    texts is written to shared storage, then read for training and for the result.
    """
    found = written(annotated(docs), "pii")
    return classified(found, fit(found))

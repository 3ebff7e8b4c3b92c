"""Soft-membership mixing: nonnegative document rates whose expected domain tokens meet targets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE_SPACE, ascii_lower, importable, let, words_of, written

#: Domains, by label, and the share of tokens that each is to have.
TARGETS = {"good": 0.95, "poor": 0.05, "toxic": 0.0}
#: Word buckets of the classifier; the driver holds so many weights for each domain, no more.
BUCKETS = 1 << 15
#: Labelled documents of a domain that the classifier is fitted on, at most.
PER_DOMAIN = 10_000
#: Pull of every rate towards one, relative to the fit.
PULL = 1e-3
#: Rounds end when no domain's rates move by more than the tolerance, on average over its tokens.
ROUNDS = 200
TOLERANCE = 1e-4


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain of a labelled document (null labels: none)."""
    return F.when(toxic == 1, "toxic").when(quality == 0, "poor").when(quality == 1, "good")


def features(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id, key (a hash of the text), tokens (words) and buckets (distinct hashed words) of every row."""
    words = words_of(ascii_lower(F.col("text")), WHITE_SPACE)
    found = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("tokens"),
            F.array_distinct(F.transform(w, lambda x: F.pmod(F.xxhash64(F.rtrim(x, F.lit(".,;:!?"))), F.lit(BUCKETS)).cast("int"))).alias("buckets"),
        ),
    )
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")
    rows = docs.select(F.col("doc_id").cast("long"), key, found.alias("f"), *also)
    return rows.select("doc_id", "key", "f.tokens", "f.buckets", *also)


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """domain and buckets of labelled documents, and the number of labels by domain.

    At most PER_DOMAIN documents of a domain, those whose doc_ids have the least hashes: the labels
    that are looked up are few, however many there are, and texts stay where they are read. A doc_id
    labelled more than once counts once, by its most severe label.
    """
    marked = labels.select(F.col("doc_id").cast("long"), domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
    marked = marked.filter("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.max("domain").alias("domain"))
    sizes = {r["domain"]: r["n"] for r in marked.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    place = Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id")
    few = marked.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= PER_DOMAIN)
    found = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(few.select("doc_id", "domain")), "doc_id")
    return written(features(found, "domain").select("domain", "buckets"), "labelled"), sizes


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bernoulli naive Bayes over hashed words: (weights by bucket and domain, bias by domain).

    Priors follow all labels, words those documents that ``labelled`` takes. Counts are combined in
    the cluster, and at most BUCKETS rows reach the driver.
    """
    rows, known = labelled(docs, labels)
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    sums = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"d{i}") for i, d in enumerate(domains)]
    counts = rows.select("domain", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(*sums).collect()
    table = np.zeros((BUCKETS, len(domains)))
    for r in counts:
        table[r["bucket"]] = [r[f"d{i}"] for i in range(len(domains))]
    n = np.array([sizes.get(d, 0) for d in domains], float)
    # Smoothed by what all domains hold, so that a word that a rarely labelled one lacks says no more than in others.
    chance = (table + (table.sum(axis=1, keepdims=True) + 0.05) / (n.sum() + 1.0)) / (n + 1.0)
    chance = np.clip(chance, 1e-6, 1 - 1e-6)
    weights = np.log(chance) - np.log1p(-chance)
    every = np.array([known.get(d, 0) for d in domains], float)
    bias = np.log1p(-chance).sum(axis=0) + np.log((every + 1) / (every.sum() + len(domains)))
    bias[n == 0] = -1e9 if n.any() else 0.0  # a domain without labels is never predicted
    return weights, bias


def posteriors(found: DataFrame, weights: np.ndarray, bias: np.ndarray) -> DataFrame:
    """doc_id, key, tokens and p (the domains' posteriors) of every row."""

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            flat = [np.asarray(b, np.int64) for b in f["buckets"]]
            sizes = np.array([len(b) for b in flat], np.int64)
            logits = np.tile(bias, (len(f), 1))
            if sizes.sum():
                begin = np.r_[0, np.cumsum(sizes)[:-1]][sizes > 0]
                logits[sizes > 0] += np.add.reduceat(weights[np.concatenate(flat)], begin, axis=0)
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "key": f["key"], "tokens": f["tokens"], "p": list(p)})

    importable(found.sparkSession)
    return found.mapInPandas(score, "doc_id long, key long, tokens long, p array<double>")


def replayed(p: np.ndarray, history: list[np.ndarray], barred: np.ndarray | bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rates, point of the next gradient, last move) after the gradients in ``history``; barred rates are zero.

    Accelerated projected gradient. A document's rate depends on its posteriors and the residuals
    alone, so each pass recomputes it, and no state has to survive between passes.
    """
    step = 1 / (1 + PULL)
    rate = ahead = np.where(barred, 0.0, np.ones(len(p)))
    move = np.zeros(len(p))
    t = 1.0
    for residual in history:
        new = np.where(barred, 0.0, np.maximum(0.0, ahead - step * (p @ residual + PULL * (ahead - 1))))
        move = np.abs(new - ahead)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        rate, ahead, t = new, new + (t - 1) / t_new * (new - rate), t_new
    return rate, ahead, move


def barred(p: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Documents whose likeliest domain is to have no tokens at all."""
    return goal[p.argmax(axis=1)] == 0


def fit_rates(scored: DataFrame, targets: dict[str, float]) -> list[np.ndarray]:
    """Residuals of the projected-gradient rounds, each domain's relative to its share of the tokens.

    Rarity thus changes neither a domain's weight nor its convergence: with shares D, the rounds
    minimise the squares of D^-1/2 (expected - goal), and their steps stay within the same bound, as
    the mean of p p' has the row sums D. One row of domain sums reaches the driver each round.
    """
    goal = np.array(list(targets.values())) / (sum(targets.values()) or 1)
    history: list[np.ndarray] = []
    names = [f"d{i}" for i in range(len(goal))]
    every = [f"{kind}{n}" for kind in "ams" for n in names]

    def summed(history: tuple) -> np.ndarray:
        def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if len(f):
                    p = np.stack(f["p"].to_numpy())
                    tokens = f["tokens"].to_numpy(float)
                    _, ahead, move = replayed(p, history, barred(p, goal))
                    yield pd.DataFrame([np.r_[(ahead * tokens) @ p, (move * tokens) @ p, tokens @ p]], columns=every)

        row = scored.mapInPandas(sums, ", ".join(f"{n} double" for n in every)).agg(*[F.sum(n) for n in every]).first()
        return np.array([x or 0.0 for x in row]).reshape(3, -1)

    for _ in range(ROUNDS):
        mass, moved, share = summed(tuple(history))
        total = share.sum()
        if not total or len(history) > 1 and (moved <= TOLERANCE * share).all():
            break
        history.append((mass - goal * total) / np.maximum(share, 1e-9 * total))
    return history


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, key, tokens, domain (the likeliest), p by domain and rate of every row of ``docs``.

    The rate is how often a document is to be drawn: least squares on the domains' expected token
    totals, with a weak pull towards one, and never below zero; zero where the likeliest domain is to
    have no tokens. Defined results: null or empty
    texts have no tokens and the prior's posteriors; a null doc_id stays and is never labelled;
    repeated rows get a row each; without labels all domains are equally likely; an empty table
    gives an empty table. Other columns are ignored.
    """
    targets = targets or TARGETS
    domains = list(targets)
    weights, bias = fit_classifier(docs, labels, domains)
    scored = written(posteriors(features(docs), weights, bias), "posteriors")
    history = fit_rates(scored, targets)
    goal = np.array(list(targets.values()))

    def rated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            p = np.stack(f["p"].to_numpy())
            rate = replayed(p, history, barred(p, goal))[0]
            out = {"doc_id": f["doc_id"].astype("Int64"), "key": f["key"], "tokens": f["tokens"]}
            out["domain"] = [domains[i] for i in p.argmax(axis=1)]
            out |= {f"p_{d}": p[:, i].round(6) for i, d in enumerate(domains)}
            yield pd.DataFrame(out | {"rate": rate.round(6)})

    columns = "".join(f", p_{d} double" for d in domains)
    return scored.mapInPandas(rated, f"doc_id long, key long, tokens long, domain string{columns}, rate double")


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` that the mixture draws, with their rate as a further (or renewed) column.

    A rate follows from the text, so rows find theirs by doc_id and a hash of the text.
    """
    rates = mixed(docs, labels, targets).filter("rate > 0").groupBy("doc_id", "key").agg(F.max("rate").alias("rate"))
    packed = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("own"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("whole"),
    )
    same = packed["id"].eqNullSafe(rates["doc_id"]) & (packed["own"] == rates["key"])
    kept = packed.join(rates, same)
    own = [F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns) if c != "rate"]
    return kept.select(*own, "rate")

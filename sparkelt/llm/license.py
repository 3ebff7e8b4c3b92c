"""License scan by diagonal voting over word k-grams."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_PLAIN, ascii_lower, literal_table, window_hashes, words_of

K = 3

#: Phrases whose every verbatim place is reported. Fixed values.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Notices recognised also when words were changed, added or left out. opening
#: sentences of public licenses.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain"),
    ("all-rights-reserved", "All rights reserved"),
)

#: Diagonals at most so far apart are one span (words added or left out shift the diagonal).
DIAGONAL_GAP = 2
#: Share of a notice's k-grams that a span must hold.
MIN_COVERAGE = 0.6
#: A span may be so many times as long as its notice.
MAX_STRETCH = 1.5


def _words(text: str) -> list[str]:
    lowered = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(NOT_PLAIN, lowered) if w]


def template_grams(phrases=PHRASES, notices=NOTICES, k: int = K) -> list[tuple]:
    """(template, label, base, position, k-gram, k-grams in all) of every template."""
    out = []
    for n, (label, text) in enumerate([*phrases, *notices]):
        words = _words(text)
        grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        if not grams:
            raise ValueError(f"template shorter than {k} words: {text!r}")
        out += [(n, label, n < len(phrases), i, g, len(grams)) for i, g in enumerate(grams)]
    return out


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, k: int = K) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the license notices in its text.

    Every rolling k-gram of a text meets the templates by its hash (they come from a list of
    parameters, hence are small enough to broadcast), is compared in full, and votes for the diagonal text position minus
    template position. A phrase stands where a diagonal holds all its k-grams. For notices,
    neighbouring diagonals are merged, then coverage and length of the span are verified.

    Only matching k-grams and one marker row per document are shuffled, by row, never by k-gram.
    Defined results: null text counts as empty; null doc_id stays; repeated rows get a row each;
    no words: zero places, empty labels, score 0; an empty table gives an empty table. Other
    columns are ignored.
    """
    templates = literal_table(
        docs.sparkSession,
        template_grams(phrases, notices, k),
        ["t", "label", "base", "tpos", "gram", "grams"],
    ).withColumn("h", F.xxhash64(*[F.xxhash64(F.get(F.split("gram", " "), F.lit(i))) for i in range(k)]))
    known = [r["h"] for r in templates.select("h").distinct().collect()]
    worded = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("rid"),
        words_of(ascii_lower(F.col("text")), NOT_PLAIN).alias("words"),
    )
    # Looking the hashes up where they arise spares exploding those of no template. Position -1 is
    # the document's marker.
    numbered = F.transform(window_hashes(F.col("words"), k), lambda h, i: F.struct(i.alias("pos"), h.alias("h")))
    marker = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("h")))
    found = worded.withColumn("found", F.concat(marker, F.filter(numbered, lambda x: x["h"].isin(known))))
    grams = found.select("doc_id", "rid", "words", F.inline("found"))
    met = grams.join(F.broadcast(templates), "h", "left")
    same = F.array_join(F.slice("words", F.greatest(F.col("pos"), F.lit(0)) + 1, k), " ") == F.col("gram")
    votes = met.filter((F.col("pos") < 0) | same).select(
        "doc_id",
        "rid",
        F.when(F.col("pos") < 0, F.size("words")).alias("n_words"),
        "t",
        "label",
        "base",
        "grams",
        "tpos",
        "pos",
        (F.col("pos") - F.col("tpos")).alias("diagonal"),
    )
    by_row = Window.partitionBy("rid", "t").orderBy("diagonal")
    diagonals = (
        votes.repartition("rid")
        .groupBy("rid", "t", "diagonal", "label", "base", "grams")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.count("tpos").alias("votes"),
            F.collect_set("tpos").alias("held"),
            F.min("pos").alias("low"),
            F.max("pos").alias("high"),
        )
        .withColumn("new", (F.col("diagonal") - F.lag("diagonal", 1, -(10**9)).over(by_row) > DIAGONAL_GAP).cast("int"))
        .withColumn("span", F.sum(F.coalesce("new", F.lit(0))).over(by_row))
    )
    spans = diagonals.groupBy("rid", "t", "span", "label", "base", "grams").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.sum(F.when(F.col("base") & (F.col("votes") == F.col("grams")), 1).otherwise(0)).alias("places"),
        F.min(F.when(F.col("base") & (F.col("votes") == F.col("grams")), F.col("diagonal"))).alias("first"),
        F.max(F.when(F.col("base") & (F.col("votes") == F.col("grams")), F.col("diagonal"))).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"),
        (F.max("high") + k - F.min("low")).alias("length"),
    )
    fits = F.col("length") <= MAX_STRETCH * (F.col("grams") + k - 1)
    coverage = F.when(F.col("t").isNull() | ~fits, F.lit(0.0)).otherwise(F.col("held") / F.col("grams"))
    judged = spans.withColumn("coverage", coverage)
    verified = ~F.col("base") & (F.col("coverage") >= MIN_COVERAGE)

    def labels(condition):
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    placed = F.col("places") > 0
    return judged.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").cast("long").alias("n_words"),
        F.sum("places").cast("long").alias("n_base"),
        F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"),
        labels(placed).alias("base_labels"),
        labels(placed | verified).alias("labels"),
        F.max(F.when(placed, F.lit(1.0)).otherwise(F.col("coverage"))).alias("score"),
    ).drop("rid")


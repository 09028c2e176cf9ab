"""License scan by an exact set-similarity join (native).

Two layers. The base layer counts the places where the words of a fixed
phrase stand consecutively. The method finds every text block that contains at
least ``threshold`` of a template's distinct words; a block is any run of
consecutive words of the whole text, across line ends, of up to ``SLACK`` times
the template's own number of words. Tokens are ordered by their frequency in
the whole corpus, rarest first. A block that reaches the threshold has its
rarest shared token in the template's prefix (the ``|T| - need + 1`` rarest
tokens), so every place of a prefix token is joined with the templates it may
stand for, with the words around it; the length filter asks for enough of the
template's tokens there, the positional filter for enough of those after the
prefix token in the global order, and the exact containment of every block
that holds the place decides.

The templates are a short parameter, so the prefix index is a literal of at
most a few dozen rows and the join is map-side. Nothing of the corpus is
broadcast.

Defined results: null text counts as empty (no words, no labels, score 0);
rows that repeat give a result row each; null ids are ordinary rows; an empty
table gives an empty table.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsort.llm.common import staged

# A word is a run of anything but these ASCII characters (texts are lower-cased before).
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
# Fixed values of the base layer: phrase -> label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Templates of the method: label -> grant sentences and the heads of license notices.
TEMPLATES = {
    "apache-2": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at",
    ),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",),
    "cc-by-nc": ("licensed under cc by nc 4 0",),
    "cc-by-sa": ("licensed under a creative commons attribution sharealike license",),
    "gpl-3": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction",
    ),
    "mpl-2": (
        "this source code is subject to the terms of the mozilla public license",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
}
# Words of a block for each word of its template, rounded up.
SLACK = 1.25
THRESHOLD = 0.8


def words_of(text: Column) -> Column:
    """Words of a text, lower-cased. ``lower`` makes an ASCII letter of one other character only, the Kelvin sign."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\ufffd"))), SEPARATOR + "+", -1), "")


def need_of(words: list[str], threshold: float) -> int:
    return math.ceil(threshold * len(words) - 1e-9)


def prepared(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, list[str], int]]:
    """(label, distinct words, words of a block) of every template."""
    return [(label, sorted(set(t.split())), math.ceil(SLACK * len(t.split()))) for label, ts in templates.items() for t in ts]


def scanned(docs: DataFrame, id_col: str, text_col: str, sets: list[tuple[str, list[str], int]], threshold: float) -> DataFrame:
    """Staged (id, th, n_words, seen, phrase, block, text), one split per text.

    ``seen`` are the words of phrases and templates in the text, ``phrase``
    says that a phrase's words all stand somewhere in it, ``block`` that it
    holds enough words of a template for one of its blocks to reach the
    threshold. Only texts with one of these are kept.
    """
    of_phrases = [sorted(set(p.split())) for p in PHRASES]
    tokens = sorted({w for ws in [*(ws for _, ws, _ in sets), *of_phrases] for w in ws})
    holds = lambda ws, n: F.size(F.array_intersect("seen", F.lit(ws))) >= n
    either = lambda tests: functools.reduce(lambda a, b: a | b, tests, F.lit(False))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    found = (src.withColumn("words", words_of(F.col("text")))
             .select("id", "text", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", F.lit(tokens)).alias("seen"))
             .select("*", either([holds(p, len(p)) for p in of_phrases]).alias("phrase"),
                     either([holds(ws, need_of(ws, threshold)) for _, ws, _ in sets]).alias("block")))
    return staged(found.select("id", F.xxhash64("text").alias("th"), "n_words", "seen", "phrase", "block",
                               F.when(F.col("phrase") | F.col("block"), F.col("text")).alias("text")), "license-texts")


def template_matches(texts: DataFrame, sets: list[tuple[str, list[str], int]], threshold: float) -> DataFrame:
    """(id, th, label, containment): every label with a block at or above the threshold, its best block."""
    spark = texts.sparkSession
    tokens = sorted({w for _, ws, _ in sets for w in ws})
    # In how many texts each token (a fixed short list) stands: the global order.
    counts = {r["t"]: r["n"] for r in texts.select(F.explode("seen").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = {w: i for i, w in enumerate(sorted(tokens, key=lambda w: (counts.get(w, 0), w)))}
    index = []
    for label, ws, size in sets:
        ws, need = sorted(ws, key=order.__getitem__), need_of(ws, threshold)
        index += [(w, label, size, ws, ws[j:], need) for j, w in enumerate(ws[: len(ws) - need + 1])]
    prefix = spark.createDataFrame(index, "token string, label string, size int, t_words array<string>, t_rest array<string>, need int")
    rare, reach = F.lit(sorted({w for w, *_ in index})), max(size for *_, size in sets) - 1
    # The places of prefix tokens, each with the words that a block may hold beside it.
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(rare, F.get("words", i)))
    around = lambda i: F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1)
    places = (texts.filter("block").filter(F.arrays_overlap("seen", rare))
              .select("id", "th", words_of(F.col("text")).alias("words"))
              .select("id", "th", F.explode(F.transform(at, lambda i: F.struct(
                  F.get("words", i).alias("token"), F.least(i, F.lit(reach)).alias("at"), around(i).alias("near")))).alias("p"))
              .select("id", "th", "p.*"))
    shared = lambda words, of: F.size(F.array_intersect(words, F.col(of)))
    first = F.greatest(F.col("at") - F.col("size") + 1, F.lit(0))
    pairs = (places.join(F.broadcast(prefix), "token")
             .withColumn("near", F.slice("near", first + 1, F.col("at") - first + F.col("size")))
             .withColumn("at", F.col("at") - first)
             .filter(shared("near", "t_words") >= F.col("need"))
             # The token is the rarest that the block shares: what else it shares comes after it.
             .filter(shared("near", "t_rest") >= F.col("need")))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.col("at")), lambda s: shared(F.slice("near", s + 1, F.col("size")), "t_words")))
    return (pairs.withColumn("shared", best).filter(F.col("shared") >= F.col("need"))
            .groupBy("id", "th", "label").agg(F.max(F.col("shared") / F.size("t_words")).alias("containment")))


def _stands_at(ws: list[str]):
    def test(i: Column) -> Column:
        hits = [F.coalesce(F.get("words", i + k) == w, F.lit(False)) for k, w in enumerate(ws)]
        return functools.reduce(lambda a, b: a & b, hits)
    return test


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    sets = prepared(templates or TEMPLATES)
    texts = scanned(docs, id_col, text_col, sets, threshold)
    found = staged(template_matches(texts, sets, threshold), "license-blocks")
    per_doc = found.groupBy("id", "th").agg(F.collect_set("label").alias("own"), F.max("containment").alias("best"))

    places = []
    for phrase in PHRASES:
        places.append(F.filter(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0))), _stands_at(phrase.split())))
    # Word positions are only worked out where a phrase may stand.
    base = (texts.withColumn("words", F.when(F.col("phrase"), words_of(F.col("text"))))
            .select("id", "th", "n_words", F.when(F.col("words").isNotNull(), F.array(*places)).alias("at"))
            .withColumn("all_at", F.flatten("at"))
            .select("id", "th", "n_words",
                    F.when(F.col("at").isNull(), 0).otherwise(F.size("all_at")).cast("long").alias("n_base"),
                    F.array_min("all_at").cast("long").alias("first_word"), F.array_max("all_at").cast("long").alias("last_word"),
                    F.when(F.col("at").isNull(), F.array().cast("array<string>")).otherwise(F.filter(F.array(*[
                        F.when(F.size(F.col("at")[k]) > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]),
                        lambda x: x.isNotNull())).alias("base")))
    d = per_doc.select(F.col("id").alias("d_id"), F.col("th").alias("d_th"), "own", "best")
    out = base.join(d, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")), "left")
    every = F.array_union(F.col("base"), F.coalesce("own", F.array().cast("array<string>")))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))

"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line of a text; its set are its distinct words. A block meets a template when at
least ``threshold`` of the template's words occur in it. Words are ordered by how many blocks
of the whole corpus hold them, rarest first. A template's prefix are its first
``size - needed + 1`` words: a block that meets it must hold one of them, so only blocks with
a prefix word are looked at. The length filter drops blocks with fewer template words than
needed; the positional filter drops those where, after the first word in common, too few words
are left on either side. What remains is counted exactly.

The templates are a parameter of bounded size and travel as literals; blocks are never
shuffled. The only shuffles are the word counts, a few hundred keys with map-side sums.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import prepare

# Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short notices by which texts name their license, under public identifiers.
TEMPLATES = [
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the"
                " terms of the GNU General Public License, either version 3 of the License, or any"
                " later version."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-2.1", "This library is free software; you can redistribute it under the terms of the GNU"
                 " Lesser General Public License version 2.1"),
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain"
                   " a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
            " software and associated documentation files, to deal in the software without"
            " restriction"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without"
                     " modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law the author has waived all copyright and related"
                " or neighboring rights to this work, CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The two letters outside A-Z whose general lower case holds an ASCII letter.
KELVIN, DOTTED_I = "K", "İ"


@dataclass(frozen=True)
class Params:
    threshold: float = 0.9
    templates: tuple = field(default=tuple(TEMPLATES))
    phrases: tuple = field(default=tuple(PHRASES.items()))


def folded(text: Column) -> Column:
    """A-Z in lower case. Other letters cannot occur in a phrase or template, so the faster
    general lower case serves wherever it turns none of them into an ASCII letter."""
    odd = text.contains(KELVIN) | text.contains(DOTTED_I)
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def spaced(text: Column) -> Column:
    """The words of a text with one space before, between and behind them."""
    words = F.trim(F.regexp_replace(folded(text), SEPARATORS, " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def template_words(text: str) -> tuple[str, ...]:
    import re

    return tuple(sorted(set(re.sub(SEPARATORS, " ", text.lower()).split())))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(docs: DataFrame, p: Params) -> DataFrame:
    """The phrase columns of every row, from ``_spaced``."""
    words = F.col("_spaced")
    hits = {phrase: words.contains(f" {phrase} ") for phrase, _ in p.phrases}

    def first(phrase: str) -> Column:
        before = F.substring(words, F.lit(1), F.instr(words, f" {phrase} ") - 1)
        return F.when(hits[phrase], _spaces(before))

    def last(phrase: str) -> Column:
        reverse = F.reverse(words)
        behind = F.instr(reverse, f" {phrase} "[::-1]) - 1 + len(phrase) + 2
        return F.when(hits[phrase], _spaces(F.substring(words, F.lit(1), F.length(words) - behind)))

    def places(phrase: str) -> Column:
        count = F.regexp_count(words, F.lit(f"(?<= ){phrase}(?= )"))
        return F.when(hits[phrase], count).otherwise(0)

    names = list(hits)
    labels = F.array(*[F.when(hits[x], F.lit(label)) for x, label in p.phrases])
    return docs.select(
        "*",
        F.when(words == "  ", 0).otherwise(_spaces(words) - 1).cast("bigint").alias("n_words"),
        sum((places(x) for x in names[1:]), places(names[0])).cast("bigint").alias("n_base"),
        F.least(*[first(x) for x in names]).cast("bigint").alias("first_word"),
        F.greatest(*[last(x) for x in names]).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(labels))).alias("_base"),
    )


def _block_words(text: Column) -> Column:
    """The distinct words of each line that could matter, as arrays."""
    return F.split(F.trim(F.regexp_replace(folded(text), SEPARATORS, " ")), " ")


def word_order(docs: DataFrame, p: Params) -> list[str]:
    """The templates' words by the number of blocks of the corpus that hold them, then by name.

    One row per template word comes back, so its size is bounded by the templates.
    """
    vocabulary = sorted({w for _, t in p.templates for w in template_words(t)})
    if not vocabulary:
        return []
    literal = F.array(*[F.lit(w) for w in vocabulary])
    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    held = lines.select(F.explode(F.array_intersect(_block_words(F.col("line")), literal)).alias("word"))
    counts = {r.word: r.n for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def needed(size: int, threshold: float) -> int:
    """Template words a block must hold."""
    return max(1, ceil(threshold * size - 1e-9))


def _met(ranks: Column, template: list[int], need: int) -> Column:
    """Whether a block's sorted word ranks meet a template's: length filter, prefix filter,
    positional filter, then the count, each only where the ones before let the block pass."""
    size = len(template)
    prefix = F.array(*[F.lit(r) for r in template[: size - need + 1]])
    whole = F.array(*[F.lit(r) for r in template])
    first = F.element_at(F.array_intersect(ranks, prefix), 1)  # ranks are sorted
    left_here = F.size(ranks) - F.array_position(ranks, first) + 1
    left_there = size - F.array_position(whole, first) + 1
    return (
        (F.size(ranks) >= need)
        & F.arrays_overlap(ranks, prefix)
        & (F.least(left_here, left_there) >= need)
        & (F.size(F.array_intersect(ranks, whole)) >= need)
    )


def _matches(order: list[str], p: Params) -> Column:
    """array<struct<block, label, containment>> of a row, from ``text`` and ``_spaced``."""
    kind = "array<struct<block:int,label:string,containment:double>>"
    if not order:
        return F.array().cast(kind)
    rank = {w: i for i, w in enumerate(order)}
    templates = [(label, sorted(rank[w] for w in words)) for label, words in
                 ((label, template_words(t)) for label, t in p.templates) if words]
    rare = {order[r] for _, t in templates for r in t[: len(t) - needed(len(t), p.threshold) + 1]}
    prefixes = F.array(*[F.lit(w) for w in sorted(rare)])
    vocabulary = F.array(*[F.lit(w) for w in order])

    def block(line: Column, at: Column) -> Column:
        words = F.array_intersect(_block_words(line), vocabulary)
        ranks = F.transform(words, lambda w: (F.array_position(vocabulary, w) - 1).cast("int"))
        return F.struct(at.alias("block"), F.array_sort(ranks).alias("ranks"))

    def found(item: Column) -> Column:
        hits = []
        for label, ranks in templates:
            share = F.size(F.array_intersect(item["ranks"], F.array(*map(F.lit, ranks)))) / len(ranks)
            hits.append(F.when(
                _met(item["ranks"], ranks, needed(len(ranks), p.threshold)),
                F.struct(item["block"].alias("block"), F.lit(label).alias("label"),
                         share.alias("containment"))))
        return F.array_compact(F.array(*hits))

    least = min(needed(len(t), p.threshold) for _, t in templates)
    blocks = F.filter(F.transform(F.split("text", "\n"), block), lambda b: F.size(b["ranks"]) >= least)
    near = F.arrays_overlap(F.split("_spaced", " "), prefixes)
    return F.when(near, F.flatten(F.transform(blocks, found))).otherwise(F.array()).cast(kind)


def scan(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """License findings for every row of ``docs`` (doc_id, text; other columns are ignored).

    n_words, n_base (places of the phrases), first_word and last_word (their smallest and
    largest first word, else null), base_labels, labels (the templates' too), score (1 with a
    phrase, else the largest containment found, else 0), matches (block, label, containment).
    Words are runs of ASCII letters, digits and non-ASCII characters; blocks are lines.

    A null text is empty: no words, empty labels, score 0. Rows come back as often as they
    occur, whatever their doc_id. An empty table gives no rows.
    """
    p = p or Params()
    prepare(docs.sparkSession)
    order = word_order(docs, p)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_spaced", spaced(F.col("text")))
    rows = _base(rows, p).withColumn("matches", _matches(order, p))
    own = F.transform("matches", lambda m: m["label"])
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", own)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
        ).alias("score"),
        "matches",
    )

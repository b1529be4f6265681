"""License scan by an exact set-similarity join, in DataFrame functions only.

A block is a line of a document, or a window of consecutive words of the whole
text, whatever lines they stand on; a template is a license notice. Both are sets
of words. A window has the template's length and room for as many other words as
may be missing, so notices are found that are wrapped, also behind comment marks.
Every block that holds at least ``THRESHOLD`` of a template's words is
found. Template words are ordered by their frequency over all documents, rarest
first. Then

* prefix: a block that misses few enough words holds one of the template's first
  ``size - needed + 1``;
* length: it has at least ``needed`` template words at all;
* position: behind the first word in common, both sides must have enough words
  left.

What passes is verified by intersecting the sets. Windows are only looked at
around words of the prefix. Documents whose words cannot contain a template are
never cut into blocks.

Besides, fixed phrases are found where their words stand consecutively.

Nulls: a null text is empty: no words, no labels, null positions. Rows are kept
one for one, repeated rows too; a null ``doc_id`` stays null. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.store import stored

THRESHOLD = 0.9
# Candidate documents that are few enough to be broadcast.
BROADCAST_ROWS = 200_000

# What stands between words, before lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# License notices and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
]


def _word_list(text: Column) -> Column:
    """Lower-cased words; one empty word where there are none."""
    return F.split(F.trim(F.lower(F.regexp_replace(text, BETWEEN, " "))), " ")


def _template_words(text: str) -> list[str]:
    marks = str.maketrans(dict.fromkeys(string.punctuation, " "))
    return sorted(set(text.lower().translate(marks).split()))


def _texts(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _needed(size: int) -> int:
    """Template words that a block must hold."""
    return -int(-THRESHOLD * size // 1)


def _window(text: str) -> int:
    """Words of a window for a template."""
    marks = str.maketrans(dict.fromkeys(string.punctuation, " "))
    return int(-(-len(text.translate(marks).split()) // THRESHOLD))


def _most_in_window(words: Column, anchors: Column, prefix: list[str], template: list[str], span: int) -> Column:
    """Template words in the best window of ``span`` words; 0 where none holds enough.

    ``anchors`` are (at, word) of words of any template's prefix. A window that holds
    enough has one of this prefix, so it lies less than ``span`` words around it.
    """
    needed = _needed(len(template))
    own = _texts(template)

    def around(anchor: Column) -> Column:
        low = F.greatest(F.lit(0), anchor["at"] - (span - 1))
        near = F.slice(words, low + 1, anchor["at"] + span - low)
        # Every window in here that can be whole, or all of it.
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(near) - (span - 1)))
        held = F.transform(starts, lambda i: F.size(F.array_intersect(own, F.slice(near, i, span))))
        return F.when(F.size(F.array_intersect(own, near)) >= needed, F.array_max(held)).otherwise(0)

    mine = F.filter(anchors, lambda x: x["word"].isin(prefix))
    most = F.coalesce(F.array_max(F.transform(mine, around)), F.lit(0))
    return F.when(most >= needed, most).otherwise(0)


def _places(words: Column, phrase: str) -> Column:
    """Where the words of a phrase start."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for at, part in enumerate(parts[1:], 1):
            found &= F.coalesce(F.get(words, i + at) == part, F.lit(False))
        return found

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _profiles(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per document: word count, phrase places, and which words of the templates it has."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), _word_list(F.col("text")).alias("words"))
    # Only A-Z are folded for phrases; few documents get this far.
    folded = F.translate(F.regexp_replace("text", BETWEEN, " "), string.ascii_uppercase, string.ascii_lowercase)
    near = F.when(F.col("text").rlike("(?i)license"), F.split(F.ltrim(folded), " "))
    rows = rows.select(
        "doc_id",
        "h",
        F.when(F.element_at("words", 1) == "", 0).otherwise(F.size("words")).cast("long").alias("n_words"),
        F.array_intersect("words", _texts(vocabulary)).alias("known"),
        near.alias("near"),
    )
    places = [F.coalesce(_places(F.col("near"), p), F.array().cast("array<int>")).alias(label) for p, label in PHRASES.items()]
    return stored(rows.select("doc_id", "h", "n_words", "known", *places), "license-words")


def _in_windows(texts: DataFrame, searches: list[tuple[str, list[str], list[str], int]]) -> DataFrame:
    """(doc_id, h, label, containment) of templates in windows of consecutive words."""
    some = sorted({w for _, prefix, _, _ in searches for w in prefix})
    rows = texts.select("doc_id", "h", _word_list(F.col("text")).alias("words"))
    placed = F.transform("words", lambda w, at: F.struct(at.alias("at"), w.alias("word")))
    rows = rows.select("doc_id", "h", "words", F.filter(placed, lambda x: x["word"].isin(some)).alias("anchors"))
    held = [
        F.struct(
            F.lit(label).alias("label"),
            (_most_in_window(F.col("words"), F.col("anchors"), prefix, words, span) / len(words)).alias("containment"),
        )
        for label, prefix, words, span in searches
    ]
    return rows.select("doc_id", "h", F.explode(F.array(*held)).alias("found")).select("doc_id", "h", "found.*").where("containment > 0")


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): word count, phrase places, labels and score.

    The score is the largest containment of a template that was found, 1 where a
    phrase stands, else 0.
    """
    sets = [(label, _template_words(text)) for label, text in TEMPLATES]
    vocabulary = sorted({w for _, words in sets for w in words})
    profiles = _profiles(docs, vocabulary)
    # One row per word of the templates.
    counted = profiles.select(F.explode("known").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    frequency = {r["word"]: r["n"] for r in counted.collect()}
    ranked = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: at for at, w in enumerate(ranked)}

    entries, possible, searches = [], F.lit(False), []
    for number, (label, words) in enumerate(sets):
        ordered = sorted(words, key=rank.get)
        needed = _needed(len(words))
        prefix = ordered[: len(words) - needed + 1]
        searches.append((label, prefix, words, _window(TEMPLATES[number][1])))
        entries += [(number, label, w, at, len(words), needed, ordered) for at, w in enumerate(prefix)]
        possible |= F.arrays_overlap("known", _texts(prefix)) & (
            F.size(F.array_intersect("known", _texts(words))) >= needed
        )
    columns = "template int, label string, word string, template_at int, template_size int, needed int, template_words array<string>"
    prefixes = docs.sparkSession.createDataFrame(entries, columns)

    wanted = profiles.where(possible).select("doc_id", "h").distinct()
    few = wanted.count() <= BROADCAST_ROWS
    wanted = wanted.toDF("wanted_id", "wanted_h")
    side = F.broadcast(wanted) if few else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("h", F.xxhash64("text"))
    texts = texts.join(side, (F.col("h") == F.col("wanted_h")) & F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    blocks = texts.select("doc_id", "h", F.posexplode(F.split("text", "\n")).alias("block", "line"))
    # Ordered by rank: the intersection keeps the order of its first side.
    blocks = blocks.select("doc_id", "h", "block", F.array_intersect(_texts(ranked), _word_list(F.col("line"))).alias("words"))
    blocks = blocks.where(F.size("words") >= min(_needed(len(w)) for _, w in sets))
    probes = blocks.select("doc_id", "h", "block", "words", F.posexplode("words").alias("block_at", "word"))
    # The prefixes are fixed values: a broadcast of known size.
    met = probes.join(F.broadcast(prefixes), "word")
    left = F.least(F.size("words") - F.col("block_at"), F.col("template_size") - F.col("template_at"))
    met = met.where((F.size("words") >= F.col("needed")) & (left + F.least("block_at", "template_at") >= F.col("needed")))
    shared = F.size(F.array_intersect("words", "template_words"))
    found = met.where(shared >= F.col("needed")).select("doc_id", "h", "label", (shared / F.col("template_size")).alias("containment"))
    found = found.unionByName(_in_windows(texts, searches))
    labels = found.groupBy("doc_id", "h").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("containment")
    ).toDF("found_id", "found_h", "found", "containment")

    rows = profiles.join(
        labels, (F.col("h") == F.col("found_h")) & F.col("doc_id").eqNullSafe(F.col("found_id")), "left"
    )
    names = list(PHRASES.values())
    starts = F.concat(*(F.col(n) for n in names))
    base = F.array_compact(F.array(*(F.when(F.size(n) > 0, n) for n in names)))
    every = F.array_distinct(F.concat(base, F.coalesce("found", F.array().cast("array<string>"))))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size(starts) > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )

"""License scans by an exact set-similarity join of text blocks with license templates.

A text is read in blocks of neighbouring words that overlap by half; a template longer than half a
block is cut into pieces. A block meets a template if it holds the given share of the template's
distinct words. The words of all templates are put in one order, rarest in the corpus first, and
three filters on that order leave few pairs to compare, none of them wrongly left out:

* prefix: of a template's words a block may miss so many; one more of the rarest ones than that
  is the prefix, and a block without any prefix word is no candidate;
* length: a block needs at least as many of the templates' words as the overlap that is asked;
* position: where the first common word stands late in either order, what follows is too short.

Words of no template can be part of no overlap and are left out of the blocks. All steps are
DataFrame expressions; the templates are the only broadcast, and their size is checked.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.session import materialize

#: Share of a template's words that a block must hold, words of a block, and words between the
#: starts of two blocks.
CONTAINMENT, BLOCK_WORDS, STEP_WORDS = 0.9, 64, 32
#: Words that all templates together may have: the bound of what is broadcast.
MOST_TEMPLATE_WORDS = 20_000

# What separates words, and phrases with their labels.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notices that licenses ask for or open with, by label.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("agpl", "GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Released under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "Copyright, all rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


class Template(NamedTuple):
    """A piece of a license text: its label and its distinct words."""

    label: str
    words: tuple[str, ...]

    def overlap(self, containment: float) -> int:
        """Words a block must share with it."""
        return max(1, math.ceil(round(containment * len(self.words), 9)))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case, other letters as they are; empty for null."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(whole) == F.length(whole)
    return F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def license_words(text: Column) -> Column:
    """Lower-cased runs of digits, letters and all characters beyond ASCII."""
    return F.array_remove(F.split(lowered(text), SEPARATOR), "")


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATOR, text.translate(str.maketrans(UPPER, LOWER))) if w]


def cut_templates(templates: Sequence[tuple[str, str]], step: int = STEP_WORDS) -> list[Template]:
    """Pieces of about equal length of no more than ``step`` words, so that some block holds each whole."""
    pieces = []
    for label, text in templates:
        words = template_words(text)
        if not words:
            raise ValueError(f"a template of {label!r} has no words")
        n = math.ceil(len(words) / step)
        bounds = [len(words) * k // n for k in range(n + 1)]
        pieces += [Template(label, tuple(dict.fromkeys(words[a:b]))) for a, b in zip(bounds, bounds[1:], strict=False)]
    if sum(len(p.words) for p in pieces) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"the templates have more than {MOST_TEMPLATE_WORDS} words")
    return list(dict.fromkeys(pieces))


def word_order(words: DataFrame, known: Sequence[str]) -> list[str]:
    """The known words by the number of texts that hold them, rarest first, ties by word.

    ``words`` has an array column of that name. Each row adds a word once; counts are combined
    before the shuffle, and only known words are counted, so the result is bounded.
    """
    known = sorted(set(known))
    held = F.array_intersect(F.lit(known), F.col("words"))
    counts = words.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    frequency = {row["word"]: row["count"] for row in counts}
    return sorted(known, key=lambda w: (frequency.get(w, 0), w))


def phrase_places(words: Column, phrase: str) -> Column:
    """Places, from 0, where the phrase's words stand one after another."""
    own = template_words(phrase)

    def here(i: Column) -> Column:
        test = F.lit(True)
        for k, word in enumerate(own):
            test = test & (F.get(words, i + k) == word)
        return test

    nothing = F.array().cast("array<int>")
    found = F.filter(F.sequence(F.lit(0), F.size(words) - len(own)), here)
    return F.when(F.size(words) >= len(own), found).otherwise(nothing)


def blocks_of(words: Column, order: Sequence[str], prefix: Sequence[str], least: int,
              block: int = BLOCK_WORDS, step: int = STEP_WORDS) -> Column:
    """The candidate blocks of a text: each the templates' words in it, in the given order.

    Blocks start every ``step`` words and go on until one reaches the end of the text. Those
    without a prefix word or with fewer than ``least`` words are left out.
    """
    n = F.ceil(F.greatest(F.size(words) - block, F.lit(0)) / step).cast("int")
    own = F.transform(
        F.sequence(F.lit(0), n),
        lambda b: F.array_intersect(F.lit(list(order)), F.slice(words, b * step + 1, F.lit(block))),
    )
    return F.filter(own, lambda b: (F.size(b) >= least) & F.arrays_overlap(b, F.lit(list(prefix))))


def join_blocks(blocks: DataFrame, templates: DataFrame, row: str) -> DataFrame:
    """Rows (row, label, containment) of the blocks that hold enough of a template.

    ``blocks`` has the row's number and ``block``, words in global order; ``templates`` one row per
    prefix word: ``word``, its place ``at``, ``template`` (words in the same order), ``label`` and
    the overlap ``need``. A pair is compared once, at its first common word.
    """
    starts = blocks.select(row, "block", F.posexplode("block").alias("here", "word"))
    met = starts.join(F.broadcast(templates), "word")
    long_enough = F.size("block") >= F.col("need")
    in_prefix = F.col("here") <= F.size("block") - F.col("need")
    # the common words before this one are none, so only what follows can be shared
    room = F.least(F.size("template") - F.col("at"), F.size("block") - F.col("here")) >= F.col("need")
    first = F.size(F.array_intersect(F.slice("block", F.lit(1), F.col("here")), "template")) == 0
    shared = F.size(F.array_intersect("template", "block"))
    pairs = met.filter(long_enough & in_prefix & room).filter(first).withColumn("shared", shared)
    return pairs.filter(F.col("shared") >= F.col("need")).select(
        row, "label", (F.col("shared") / F.size("template")).alias("containment")
    )


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES, containment: float = CONTAINMENT,
) -> DataFrame:
    """Rows (key, n_words, n_base, first_word, last_word, base_labels, labels, score), one per row.

    ``n_base`` counts the places of all phrases, ``first_word`` and ``last_word`` are the smallest
    and largest of them, in words from 0, null without any. ``labels`` adds the templates' labels
    to those of the phrases; both lists are distinct, sorted and comma-joined. ``score`` is the
    highest containment that reaches the threshold, 1 where a phrase was found, 0 where nothing
    was. A null or empty text has no words; equal rows are judged alike and each returned, whatever
    their key, null included. Other columns are not carried.
    """
    if not 0 < containment <= 1:
        raise ValueError("containment above 0, up to 1")
    pieces = cut_templates(templates)
    # the key goes by a name of its own, so that it meets no column made here
    row, own = "row", "key"
    slim = docs.select(F.col(f"`{key}`").alias(own), F.col(f"`{text}`").cast("string").alias("text"))
    worded = slim.select(own, license_words(F.col("text")).alias("words"))
    known = {w for t in pieces for w in t.words} | {w for p in phrases for w in template_words(p)}
    order = word_order(worded.select("words"), sorted(known))
    place = {word: k for k, word in enumerate(order)}
    index = []
    for piece in pieces:
        ranked = sorted(piece.words, key=place.__getitem__)
        need = piece.overlap(containment)
        index += [(word, at, ranked, piece.label, need) for at, word in enumerate(ranked[: len(ranked) - need + 1])]
    prefix = sorted({entry[0] for entry in index})
    least = min((entry[4] for entry in index), default=1)
    # a phrase cannot stand where its rarest word is missing, so most texts need no closer look
    rarest = {min(template_words(p), key=place.__getitem__) for p in phrases}
    gated = worded.withColumn("open", F.arrays_overlap("words", F.lit(sorted({*prefix, *rarest}))))

    def looked(found: Column, kind: str) -> Column:
        return F.when(F.col("open"), found).otherwise(F.array().cast(kind))

    bases = [
        F.struct(F.lit(label).alias("label"), looked(phrase_places(F.col("words"), p), "array<int>").alias("places"))
        for p, label in phrases.items()
    ]
    found = gated.select(
        F.monotonically_increasing_id().alias(row),
        own,
        F.size("words").cast("long").alias("n_words"),
        F.array(*bases).cast("array<struct<label:string,places:array<int>>>").alias("base"),
        looked(blocks_of(F.col("words"), order, prefix, least), "array<array<string>>").alias("blocks"),
    )
    # written once: the row numbers stay, and the texts are read no more
    found = materialize(found, "license-blocks")
    base = found.select(
        row, own, "n_words", "blocks",
        F.flatten(F.transform("base", lambda b: b["places"])).alias("places"),
        F.transform(F.filter("base", lambda b: F.size(b["places"]) > 0), lambda b: b["label"]).alias("base_labels"),
    )
    table = docs.sparkSession.createDataFrame(
        index, "word string, at int, template array<string>, label string, need int"
    )
    hits = join_blocks(found.select(row, F.explode("blocks").alias("block")), table, row)
    named = hits.groupBy(row).agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    held = F.size("places") > 0
    candidates = base.filter(F.size("blocks") > 0).join(named, row, "left")
    others = base.filter(F.size("blocks") == 0).withColumns(
        {"more": F.lit(None).cast("array<string>"), "best": F.lit(None).cast("double")}
    )
    everything = candidates.select(others.columns).unionByName(others)
    none = F.array().cast("array<string>")
    return everything.select(
        F.col(own).alias(key),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_labels")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("more", none))), ",").alias("labels"),
        F.when(held, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

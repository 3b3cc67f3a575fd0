"""License scan: an exact set-similarity join of text blocks with license templates.

DataFrame functions only. A template is the set of its distinct words; a block
is a stretch of a text's words, twice as long as the templates that are held
against it, so any run of words as long as a template stands whole in a block.
A block matches when it contains the template's threshold share of words.

The join is the prefix-filter join: all sets are ordered by the words'
frequency in the corpus, rarest first, and only sets that share a word of their
prefixes are compared. So blocks are built only around words of a template's
prefix; length and positional filters discard more of them before the overlap
is counted.
"""

from __future__ import annotations

import json
import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.columns import evaluate_once
from clickweave.llm.common import ascii_lower
from clickweave.session import materialize

#: A word: ASCII letters (A-Z as a-z), digits and any characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that give a label wherever their words stand in a row.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Notices of public licenses and their labels.
NOTICES = [
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation", "gpl"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "cc-by-nc"),
]


class Template(NamedTuple):
    label: str
    phrase: bool  #: all words, in a row
    words: list[str]  #: as they stand
    tokens: list[str]  #: distinct
    need: int  #: tokens that a block must hold
    stride: int  #: blocks begin at each multiple of it and are twice as long


def templates_of(phrases: list[tuple[str, str]], notices: list[tuple[str, str]], threshold: float) -> list[Template]:
    out = []
    for text, label, phrase in [(*p, True) for p in phrases] + [(*n, False) for n in notices]:
        words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))
        if not words:
            raise ValueError(f"a template without words: {text!r}")
        tokens = sorted(set(words))
        need = len(tokens) if phrase else max(1, math.ceil(threshold * len(tokens) - 1e-9))
        out.append(Template(label, phrase, words, tokens, need, max(8, 1 << (len(words) - 1).bit_length())))
    return out


def _words_of(docs: DataFrame) -> DataFrame:
    """``row`` (a number of its own), ``doc_id``, ``words``."""
    read = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
    )
    return read.select("row", "doc_id", evaluate_once(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _among(word: Column, values: set[str]) -> Column:
    """Membership in a set of literals (hashed; the never matching entries keep Spark from a chain of comparisons)."""
    return word.isin(sorted(values) + [f" {i}" for i in range(max(0, 11 - len(values)))])


def _blocks(stride: int, anchors: set[str], vocabulary: set[str], need: int) -> Column:
    """The blocks of ``stride`` around the words of ``anchors``: stride, start
    and the words of ``vocabulary`` with their places, if they are ``need`` at least."""
    near = F.filter("anchors", lambda x: _among(x["word"], anchors))
    here = F.transform(near, lambda x: x["at"] - x["at"] % stride)
    starts = F.array_distinct(F.concat(here, F.filter(F.transform(here, lambda s: s - stride), lambda s: s >= 0)))

    def block(start: Column) -> Column:
        stretch = F.slice("words", start + 1, 2 * stride)
        hits = F.transform(stretch, lambda w, i: F.when(_among(w, vocabulary), F.struct((start + i).alias("at"), w.alias("word"))))
        return F.struct(F.lit(stride).alias("stride"), start.alias("start"), F.filter(hits, lambda h: h.isNotNull()).alias("hits"))

    return F.filter(F.transform(starts, block), lambda b: F.size(F.array_distinct(b["hits"]["word"])) >= need)


def scan_licenses(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
    threshold: float = 0.8,
) -> DataFrame:
    """License labels of every row of ``docs`` (``doc_id``, ``text``).

    Returns doc_id, n_words, n_base (places where a phrase's words stand in a
    row), first_word, last_word (the smallest and largest of these places, null
    without any), base_labels (of the phrases found), labels (also of the
    notices of which a block holds ``threshold`` of the distinct words, unless
    they are a part of those of another notice found in the block), both
    distinct, sorted and comma-joined, and score (the greatest share found; 1
    with a base label, 0 without labels).

    Words are runs of ASCII letters (A-Z as a-z), digits and any characters
    beyond ASCII. Null and empty texts have no words and no labels. A null
    doc_id stays null; rows that repeat an id or a text are judged each. Words
    of equal frequency are ordered by their text, which changes no result. Very
    long texts are read whole; beyond the words of a text only blocks near a
    rare template word are held. An empty table gives an empty table. Other
    columns are not read, whatever they are called.

    Templates are parameters, a few hundred at most: their words are sent with
    the plan.
    """
    spark = docs.sparkSession
    templates = templates_of(phrases, notices, threshold)
    vocabulary = {t for x in templates for t in x.tokens}

    # the global order: rarest first, over all words of all texts
    words = _words_of(docs).select(F.explode("words").alias("word"))
    counted = words.filter(_among(F.col("word"), vocabulary)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequency = {r["word"]: r["n"] for r in counted.collect()}  # at most the templates' words
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    ordered = [x._replace(tokens=sorted(x.tokens, key=place.__getitem__)) for x in templates]
    prefixes = [x.tokens[: len(x.tokens) - x.need + 1] for x in ordered]

    anchor_words = {w for p in prefixes for w in p}
    anchors = F.transform("words", lambda w, i: F.when(_among(w, anchor_words), F.struct(i.alias("at"), w.alias("word"))))
    marked = _words_of(docs).select("row", "doc_id", "words", evaluate_once(F.filter(anchors, lambda x: x.isNotNull())).alias("anchors"))
    groups = []
    for stride in sorted({x.stride for x in ordered}):
        held = [i for i, x in enumerate(ordered) if x.stride == stride]
        own_words = {w for i in held for w in ordered[i].tokens}
        own_anchors = {w for i in held for w in prefixes[i]}
        groups.append(_blocks(stride, own_anchors, own_words, min(ordered[i].need for i in held)))
    found = materialize(marked.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.concat(*groups).alias("blocks")), "blocks")

    rows = [
        {"stride": x.stride, "word": w, "label": x.label, "phrase": x.phrase, "template": x.words, "tokens": x.tokens, "need": x.need}
        for x, prefix in zip(ordered, prefixes)
        for w in prefix
    ]
    kinds = "stride:int,word:string,label:string,phrase:boolean,template:array<string>,tokens:array<string>,need:int"
    index = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kinds}>>")))
    blocks = found.select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    least = {s: min(x.need for x in ordered if x.stride == s) for s in {x.stride for x in ordered}}
    least_need = F.coalesce(*(F.when(F.col("stride") == s, F.lit(n)) for s, n in least.items()))
    in_order = F.array_intersect(_strings(order), F.col("hits.word"))
    sets = blocks.select("row", "stride", "start", "hits", evaluate_once(in_order).alias("block"))
    probes = sets.select("*", F.explode(F.slice("block", 1, F.size("block") - least_need + 1)).alias("word"))
    pairs = probes.join(F.broadcast(index), ["stride", "word"])  # bounded by the templates' words
    size, of = F.size("block"), F.size("tokens")
    pairs = pairs.filter(size >= F.col("need"))  # length filter
    shared = F.array_intersect(F.slice("block", 1, F.greatest(size - F.col("need") + 1, F.lit(0))), F.slice("tokens", 1, of - F.col("need") + 1))
    pairs = pairs.withColumn("shared", shared).filter(F.col("word") == F.get("shared", F.lit(0)))  # each pair once
    last = F.try_element_at("shared", F.lit(-1))
    rest = F.least(size - F.array_position("block", last), of - F.array_position("tokens", last))
    pairs = pairs.filter(F.size("shared") + rest >= F.col("need"))  # positional filter
    held = F.array_intersect("block", "tokens")
    matches = pairs.withColumn("held", held).filter(F.size("held") >= F.col("need"))

    # exact check of the phrases: places of the first word with each further word behind it; a place counts in
    # the block in whose first half it stands
    def places_of(k: Column) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == F.element_at("template", k)), lambda h: h["at"] - k + 1)

    in_a_row = F.aggregate(F.sequence(F.lit(1), F.size("template")), places_of(F.lit(1)), lambda found, k: F.array_intersect(found, places_of(k)))
    own = F.filter(in_a_row, lambda at: (at >= F.col("start")) & (at < F.col("start") + F.col("stride")))
    matches = matches.withColumn("places", F.when(F.col("phrase"), own))
    matches = matches.filter(~F.col("phrase") | (F.size("places") > 0))
    # of the notices in one block, one whose words are all another's, with more, says nothing of its own
    match = F.struct("label", "phrase", "places", "held", (F.size("held") / of).alias("share"))
    together = matches.groupBy("row", "stride", "start").agg(F.collect_list(match).alias("all"))  # as many as templates

    def told_by_another(m: Column) -> Column:
        more = F.filter("all", lambda u: ~u["phrase"] & (F.size(u["held"]) > F.size(m["held"])))
        return F.exists(more, lambda u: F.size(F.array_except(m["held"], u["held"])) == 0)

    kept = together.select("row", F.explode(F.filter("all", lambda m: m["phrase"] | ~told_by_another(m))).alias("m")).select("row", "m.*")
    per_row = kept.groupBy("row").agg(
        F.sum(F.when(F.col("phrase"), F.size("places")).otherwise(0)).alias("n_base"),
        F.min(F.array_min("places")).cast("long").alias("first_word"),
        F.max(F.array_max("places")).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    return found.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        *(F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

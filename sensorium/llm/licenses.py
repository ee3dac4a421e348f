"""License scans: exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words, whatever lines it spans, of a template's length over the threshold (so a quarter of
foreign words may stand between); a shorter text is one block. Block and template are sets of words, and a template is found
where |block & template| >= THRESHOLD * |template|, the block holds every word that the template's label cannot do
without (a name, a version), and none that makes it another license (``lesser``, ``nc``). Only DataFrame functions run:

* template words are ordered by the number of documents that hold them, rarest first (a count over
  all documents, taken for the bounded vocabulary of the templates only);
* prefix filter: a matching block holds the rarest required word, or for a template without any one of its first
  |T| - need + 1 words. Documents without are left out at once, and in the others only blocks around
  such words are looked at, each once (by the first such word that it holds);
* length filter: the words around hold at least ``need`` words of the template;
* positional filter: with a prefix word at place i of the template and j of the words around,
  the overlap is at most i + 1 + min(words after i, words after j);
* what remains is verified by the exact intersection.

Independently of the templates, phrases are located word by word (``base`` labels). The templates
are a parameter of known size, and become literals of the plan; no documents are shuffled but for the counts.

Defined results: null text counts as empty (no words, no labels, score 0); null ids are returned as they
are; repeated rows are each returned; long texts are read whole, by the words around prefix words only; an empty table
gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted

THRESHOLD = 0.8

#: Phrase and label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}



class Template(NamedTuple):
    label: str
    wording: str
    required: str  # words that the label cannot do without
    excluded: str = ""  # words of close licenses


#: Label and wording of common notices.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license 2 0"),
    Template("apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache license 2 0"),
    Template("mit", "Released under the MIT License", "mit license"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                    "(the \"Software\"), to deal in the Software without restriction", "permission granted software restriction"),
    Template("bsd", "Released under the BSD License", "bsd license"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted",
             "redistribution source binary permitted"),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", "gnu general public license 2", "lesser library affero 3"),
    Template("gpl-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
             "gnu general public license 2", "lesser library affero 3"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "gnu general public license 3", "lesser library affero 2"),
    Template("gpl-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
             "gnu general public license 3", "lesser library affero 2"),
    Template("lgpl", "This library is licensed under the GNU Lesser General Public License", "gnu lesser general public license"),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "gnu lesser general public license"),
    Template("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3", "gnu affero general public license 3"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license 2 0"),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", "cc by 4 0", "nc nd sa"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution 4 0",
             "noncommercial sharealike noderivatives"),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", "cc by sa 4 0", "nc nd"),
    Template("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             "creative commons attribution sharealike 4 0", "noncommercial"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", "cc by nc 4 0", "nd sa"),
    Template("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             "creative commons attribution noncommercial 4 0", "sharealike noderivatives"),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
             "waived copyright rights law"),
    Template("all-rights-reserved", "All rights reserved", "all rights reserved"),
)


def words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def needed(template: Template, threshold: float = THRESHOLD) -> int:
    return math.ceil(round(threshold * len(set(words(template.wording))), 9))


def block_words(template: Template, threshold: float = THRESHOLD) -> int:
    return math.ceil(round(len(words(template.wording)) / threshold, 9))


def folded(text: Column) -> Column:
    """ASCII letters in lower case; what is no word becomes one space, line ends stay.

    ``lower`` also folds other letters, which no ASCII word of a phrase or template can tell,
    but for the Kelvin sign: its lower case is the ASCII k, so it is replaced first.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u212b")))
    return F.regexp_replace(low, "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " ")


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def document_counts(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """The number of documents that hold each word; ``texts`` has a folded column ``t``."""
    seen = texts.select(F.explode(F.array_intersect(F.split("t", "[ \n]+"), _literal(vocabulary))).alias("w"))
    return {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count("*").alias("n")).collect()}  # at most len(vocabulary) rows


class _Rule(NamedTuple):
    """A template made ready: its words from the rarest on."""

    label: str
    ordered: list[str]
    prefix: list[str]
    required: list[str]
    excluded: list[str]
    need: int
    length: int


def _rules(texts: DataFrame, templates: Sequence[Template], threshold: float) -> list[_Rule]:
    counts = document_counts(texts, sorted({w for t in templates for w in words(t.wording)}))
    rare = lambda ws: sorted(set(ws), key=lambda w: (counts.get(w, 0), w))
    out = []
    for t in templates:
        ordered, required, need = rare(words(t.wording)), rare(words(t.required)), needed(t, threshold)
        prefix = required[:1] or ordered[:len(ordered) - need + 1]
        out.append(_Rule(t.label, ordered, prefix, required, words(t.excluded), need, block_words(t, threshold)))
    return out


def _holds(flat: Column, ws: list[str]) -> list[Column]:
    return [F.contains(flat, F.lit(f" {w} ")) for w in ws]


def _possible(flat: Column, rule: _Rule) -> Column:
    """A prefix word and all required words are somewhere in the text (``flat`` has one space on either side of each word)."""
    return reduce(Column.__and__, _holds(flat, rule.required), reduce(Column.__or__, _holds(flat, rule.prefix)))


def _may_match(around: Column, rule: _Rule) -> Column:
    """Length and positional filter on the words around a prefix word."""
    common = F.array_intersect(_literal(rule.ordered), around)  # in the template's order
    possible = F.lit(False)
    for i, w in enumerate(rule.ordered):
        if w in rule.prefix:
            j = F.array_position(common, F.lit(w))
            after = F.least(F.lit(len(rule.ordered) - i - 1), F.size(common) - j)
            possible = possible | ((j > 0) & (after + 1 + i >= rule.need))  # up to i rarer common words come before
    return (F.size(common) >= rule.need) & possible


def _matches(w: Column, n: Column, rule: _Rule) -> Column:
    """array<struct<word, label, containment>>: the blocks of the words ``w`` (``n`` of them) that match."""
    size = rule.length
    anchors = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at(w, i).isin(rule.prefix))
    ends = F.transform(F.arrays_zip(anchors.alias("a"), F.concat(F.array(F.lit(0)), anchors).alias("b")), lambda x: F.struct(x["a"].alias("at"), x["b"].alias("before")))
    # blocks whose first prefix word is this one
    spans = F.transform(F.filter(ends, lambda x: x["at"].isNotNull()), lambda x: F.struct(
        F.greatest(x["before"] + 1, x["at"] - size + 1, F.lit(1)).alias("lo"), F.least(x["at"], F.greatest(n - size + 1, F.lit(1))).alias("hi")))
    some = F.filter(spans, lambda x: (x["lo"] <= x["hi"]) & _may_match(F.slice(w, x["lo"], x["hi"] - x["lo"] + size), rule))
    starts = F.flatten(F.transform(some, lambda x: F.sequence(x["lo"], x["hi"])))

    def checked(start: Column) -> Column:
        block = F.slice(w, start, F.lit(size))
        common = F.size(F.array_intersect(_literal(rule.ordered), block))
        fits = reduce(Column.__and__, [F.array_contains(block, r) for r in rule.required], common >= rule.need)
        if rule.excluded:
            fits = fits & ~F.arrays_overlap(block, _literal(rule.excluded))
        return F.when(fits, F.struct((start - 1).cast("long").alias("word"), F.lit(rule.label).alias("label"),
                                     (common / F.lit(float(len(rule.ordered)))).alias("containment")))

    return F.array_compact(F.transform(starts, checked))


_NONE = "cast(array() as array<struct<word:bigint,label:string,containment:double>>)"


def _scanned(docs: DataFrame, id_col: str, text_col: str, templates: Sequence[Template], threshold: float) -> DataFrame:
    """id, flat (the words with one space on either side, after a "."), n_words, m (the matches)."""
    texts = docs.select(quoted(id_col).alias("id"), folded(quoted(text_col)).alias("t"))
    rules = _rules(texts, templates, threshold)
    # "." stands for the text's start, so that no phrase begins at character 0
    flat = F.concat(F.lit(". "), F.trim(F.regexp_replace("t", "[ \n]+", " ")), F.lit(" "))
    rows = texts.select("id", flat.alias("flat"))
    rows = rows.withColumn("n_words", F.when(F.col("flat") == ".  ", F.lit(0)).otherwise(_spaces(F.col("flat")) - 1).cast("long"))
    rows = rows.select("*", F.array(*[_possible(F.col("flat"), r) for r in rules]).alias("possible"))
    rows = rows.select("*", F.when(F.array_contains("possible", True), F.slice(F.split("flat", " "), F.lit(2), F.col("n_words").cast("int"))).alias("w"))
    found = [F.when(F.col("possible")[i], _matches(F.col("w"), F.col("n_words").cast("int"), r)) for i, r in enumerate(rules)]
    none = F.expr(_NONE)
    m = F.when(F.col("w").isNull(), none).otherwise(F.array_distinct(F.array_sort(F.flatten(F.array_compact(F.array(*found)))))) if rules else none
    return rows.select("id", "flat", "n_words", F.coalesce(m, none).alias("m"))


def template_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     templates: Sequence[Template] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every (document, block, template) at or over the threshold: id, word (the block's first, from 0), label, containment."""
    # an outer explode: the filter that Spark derives from an inner one would be pushed below, and split the text for each word
    found = _scanned(docs, id_col, text_col, templates, threshold).select("id", F.explode_outer("m").alias("m"))
    return found.filter("m.label IS NOT NULL").select(F.col("id").alias(id_col), F.col("m.word").alias("word"), F.col("m.label").alias("label"), F.col("m.containment").alias("containment"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[Template] = TEMPLATES,
                  phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches."""
    rows = _scanned(docs, id_col, text_col, templates, threshold)
    cuts = [F.when(F.contains("flat", F.lit(f" {p} ")), F.split("flat", f"(?= {p} )")) for p in phrases]
    rows = rows.select("*", *[c.alias(f"cut{i}") for i, c in enumerate(cuts)])
    n = [F.when(F.col(f"cut{i}").isNull(), 0).otherwise(F.size(F.col(f"cut{i}")) - 1) for i in range(len(cuts))]
    first = [_spaces(F.col(f"cut{i}")[0]) for i in range(len(cuts))]
    last = [F.col("n_words") + 1 - _spaces(F.element_at(F.col(f"cut{i}"), -1)) for i in range(len(cuts))]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(
        *[F.when(F.col(f"cut{i}").isNotNull(), F.lit(v)) for i, v in enumerate(phrases.values())]))))
    own = F.transform("m", lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("m", lambda x: x["containment"])), F.lit(0.0))
    n_base = sum(n[1:], n[0]).cast("long")
    return rows.select(
        F.col("id").alias(id_col), "n_words", n_base.alias("n_base"),
        F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(best).alias("score"), F.col("m").alias("matches"))

"""Licence scan by a positional rare-token index, DataFrame functions only.

The index lists, for every word of the licence templates, the places where it
stands in each template. A file is scanned in its own row, so nothing is
shuffled and a file of any length stays where it was read:

1. Its licence words with their places are taken out. A template is looked at
   only if the file has every word of the template's key phrases.
2. Of the template's words that the file has, the ``PROBES`` of highest IDF are
   looked up: a word at place p of the file and q of the template votes for the
   relative position p - q. Positions fall into cells of ``CELL`` words that
   overlap by half, so a few words more or less between two probes do no harm.
   Cells where at least half of the probes meet are kept (the votes are sorted;
   a cell has m votes if the vote m - 1 places further is the same).
3. A cell stays if each key phrase stands, word by word, at its own relative
   position there. What is left is scored: the IDF weight of the template words
   found at that position over the weight of all of them; a template is found
   from ``SHARE`` on.

IDF is ln((N + 1) / (df + 1)) in thousandths, over all N documents; only the
counts of template words reach the driver. Fixed base phrases are found at
whatever place they stand, apart from the templates.

Cases: null text is the empty text and has no words; of several places of a
template the best one gives its score; ties of IDF are broken by the word;
repeated rows count and come out each; an empty table gives no rows; a column
named like the output is replaced, all others pass through.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from .common import lower_ascii, tmp

#: Letters and digits of ASCII and everything beyond ASCII.
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PROBES, CELL, SHARE = 4, 16, 0.6

#: Base phrases and labels (fixed values).
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    """A licence notice with the phrases that must stand in it."""
    name: str
    label: str
    text: str
    phrases: tuple[str, ...]


#: Notices and opening passages of common licences (fixed values).
TEMPLATES = (
    Template("mit-notice", "mit-notice", "Released under the MIT License.", ("mit license",)),
    Template("mit-text", "mit-text",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
             "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
             "copies of the Software",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("apache-2.0-notice", "apache-2.0", "Licensed under the Apache License, Version 2.0.",
             ("apache license version 2 0",)),
    Template("apache-2.0-text", "apache-2.0",
             "Unless required by applicable law or agreed to in writing, software distributed under the License is "
             "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
             ("unless required by applicable law or agreed to in writing", "without warranties or conditions of any kind")),
    Template("gpl-3.0-notice", "gpl-3.0", "This work is licensed under the GNU General Public License, version 3.",
             ("gnu general public license version 3",)),
    Template("gpl-2.0-notice", "gpl-2.0", "This work is licensed under the GNU General Public License, version 2.",
             ("gnu general public license version 2",)),
    Template("gpl-text", "gpl-text",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation",
             ("you can redistribute it and or modify it under the terms", "gnu general public license")),
    Template("lgpl-notice", "lgpl", "Licensed under the GNU Lesser General Public License.",
             ("gnu lesser general public license",)),
    Template("agpl-notice", "agpl", "Licensed under the GNU Affero General Public License.",
             ("gnu affero general public license",)),
    Template("mpl-2.0-notice", "mpl-2.0",
             "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
             ("mozilla public license v 2 0",)),
    Template("bsd-text", "bsd",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met",
             ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("isc-text", "isc",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
             ("for any purpose with or without fee", "appear in all copies")),
    Template("unlicense-text", "unlicense",
             "This is free and unencumbered software released into the public domain.",
             ("unencumbered software released into the public domain",)),
    Template("cc-by-nc-4.0-notice", "cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0-notice", "cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ("cc by sa 4 0",)),
    Template("cc-by-4.0-notice", "cc-by-4.0", "Licensed under CC BY 4.0.", ("cc by 4 0",)),
)


def tokens(text: str) -> list[str]:
    """Words of a template."""
    return re.findall(TOKEN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def place_of(phrase: list[str], words: list[str]) -> int:
    """First place of a phrase in its template."""
    return next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)


def words_column(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def hits_column(words: Column, vocabulary: list[str]) -> Column:
    """``array<struct<w, at>>``: words of the vocabulary and their places."""
    at = F.transform(words, lambda w, i: F.when(w.isin(vocabulary), i))
    return F.transform(F.array_compact(at), lambda i: F.struct(F.get(words, i).alias("w"), i.alias("at")))


def idf(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """IDF of every word of the vocabulary over all documents, in thousandths,
    1 at least."""
    mark = F.lit("")                              # no word: counts the documents
    words = docs.select(words_column(F.col(text)).alias("words"))
    held = F.filter("words", lambda w: w.isin(vocabulary))
    got = dict(words.select(F.explode(F.array_append(F.array_distinct(held), mark)).alias("w"))
               .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())
    return {w: max(1, round(1000 * math.log((got.get("", 0) + 1) / (got.get(w, 0) + 1)))) for w in vocabulary}


INDEX = ("array<struct<name: string, label: string, total: long, needs: array<string>, "
         "words: array<struct<w: string, at: array<int>, weight: long>>, "
         "phrases: array<struct<ws: array<string>, at: int>>>>")


def index(templates: tuple[Template, ...], weight: dict[str, int]) -> Column:
    """The positional index as a constant: words by falling IDF."""
    out = []
    for t in templates:
        words, phrases = tokens(t.text), [tokens(p) for p in t.phrases]
        postings = [{"w": w, "at": [i for i, x in enumerate(words) if x == w], "weight": weight[w]} for w in set(words)]
        postings.sort(key=lambda p: (-p["weight"], p["w"]))
        out.append({"name": t.name, "label": t.label, "total": sum(p["weight"] for p in postings),
                    "needs": sorted({w for p in phrases for w in p}), "words": postings,
                    "phrases": [{"ws": p, "at": place_of(p, words)} for p in phrases]})
    return F.from_json(F.lit(json.dumps(out)), INDEX)


def places(phrase: Column, words: Column, hits: Column) -> Column:
    """Where a phrase's words stand consecutively."""
    first = F.filter(hits, lambda h: h["w"] == F.get(phrase, F.lit(0)))
    return F.transform(F.filter(first, lambda h: F.slice(words, h["at"] + 1, F.size(phrase)) == phrase),
                       lambda h: h["at"])


def cells(position: Column) -> Column:
    """The two overlapping cells of a relative position."""
    bits = CELL.bit_length() - 1
    return F.array(F.shiftright(position, bits) * 2, F.shiftright(position + CELL // 2, bits) * 2 + 1)


def votes(posting: Column, hits: Column) -> Column:
    """Distinct cells that a word's places in file and template speak for."""
    mine = F.filter(hits, lambda h: h["w"] == posting["w"])
    return F.array_distinct(F.flatten(F.transform(mine, lambda h: F.flatten(
        F.transform(posting["at"], lambda q: cells(h["at"] - q))))))


def supported(template: Column, hits: Column, present: Column) -> Column:
    """Cells where at least half of the file's rarest template words meet."""
    probes = F.slice(F.filter(template["words"], lambda p: F.array_contains(present, p["w"])), 1, PROBES)

    def met(p):
        need = F.ceil(F.size(p) / 2).cast("int")
        sorted_votes = F.array_sort(F.flatten(F.transform(p, lambda x: votes(x, hits))))
        return bind(sorted_votes, lambda v: F.array_distinct(F.array_compact(F.transform(
            v, lambda c, i: F.when(F.get(v, i + need - 1) == c, c)))))
    return bind(probes, met)


def verified(template: Column, found: Column, words: Column, hits: Column) -> Column:
    """Those cells at which every key phrase has its place."""
    return F.aggregate(template["phrases"], found, lambda left, p: F.when(F.size(left) == 0, left).otherwise(
        F.array_intersect(left, F.flatten(F.transform(places(p["ws"], words, hits), lambda at: cells(at - p["at"]))))))


def best_share(template: Column, left: Column, hits: Column) -> Column:
    """Largest share of the template's weight found in one of the cells."""
    marks = F.array_sort(F.flatten(F.transform(template["words"], lambda p: F.transform(
        F.array_intersect(votes(p, hits), left), lambda c: F.struct(c.alias("cell"), p["weight"].alias("weight"))))))
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(None).cast("int").alias("cell"), zero.alias("sum"), zero.alias("best"))

    def step(s, m):
        total = F.when(s["cell"] == m["cell"], s["sum"]).otherwise(zero) + m["weight"]
        return F.struct(m["cell"].alias("cell"), total.alias("sum"), F.greatest(s["best"], total).alias("best"))
    return F.aggregate(marks, start, step, lambda s: s["best"]) / template["total"]


MATCH = "array<struct<name: string, label: string, score: double, places: array<int>>>"


def matches(catalogue: Column, words: Column, hits: Column, present: Column) -> Column:
    """Found templates with their scores and the places of their first key
    phrase."""
    def scan(t):
        left = bind(supported(t, hits, present), lambda c: verified(t, c, words, hits))
        return bind(left, lambda v: F.when(F.size(v) > 0, F.struct(
            t["name"].alias("name"), t["label"].alias("label"), best_share(t, v, hits).alias("score"),
            places(t["phrases"][0]["ws"], words, hits).alias("places"))))
    asked = F.filter(catalogue, lambda t: F.size(F.array_except(t["needs"], present)) == 0)
    found = F.filter(F.transform(asked, scan), lambda m: m.isNotNull() & (m["score"] >= SHARE))
    return F.coalesce(found, F.lit(None).cast(MATCH))


def scan(docs: DataFrame, text: str = "text", out: str = "licence", templates: tuple[Template, ...] = TEMPLATES,
         base: tuple[tuple[str, str], ...] = BASE) -> DataFrame:
    """``docs`` plus ``out``: a struct of ``n_words``, ``base`` (places of each
    base phrase with its label) and ``found`` (templates: name, label, score,
    places)."""
    vocabulary = sorted({w for t in templates for w in tokens(t.text)} | {w for p, _ in base for w in p.split()})
    docs = docs.drop(out)
    catalogue = index(templates, idf(docs, text, vocabulary))
    words, hits, present = tmp("words"), tmp("hits"), tmp("present")
    rows = docs.withColumn(words, words_column(F.col(text)))
    rows = rows.withColumn(hits, hits_column(F.col(words), vocabulary))
    rows = rows.withColumn(present, F.array_distinct(F.col(hits)["w"]))
    phrases = F.array(*[F.struct(
        F.lit(label).alias("label"),
        places(F.array(*[F.lit(w) for w in phrase.split()]), F.col(words), F.col(hits)).alias("places"))
        for phrase, label in base])
    rows = rows.withColumn(out, F.struct(
        F.size(words).cast("long").alias("n_words"), phrases.alias("base"),
        matches(catalogue, F.col(words), F.col(hits), F.col(present)).alias("found")))
    return rows.drop(words, hits, present)


def labels(of: Column) -> Column:
    """Distinct labels, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(of)), ",")

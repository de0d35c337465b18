"""Licence scans with a trained paragraph classifier, in built-in DataFrame functions only.

A softmax regression over word unigrams and bigrams tells licence families and an unknown class apart. It
is trained on the driver from each family's names in the usual sentences, its notices and the paragraphs of
its text (notices.py), and from sentences that speak of licences without granting one, or of other things,
as the unknown class; a part is held out to fit a temperature, so that probabilities are calibrated. Weights,
rounded to six places, are literals of the plan: their number depends on these texts alone.

A document's lines are its paragraphs; neighbouring lines, up to one that ends a sentence or precedes one
without a letter or digit, are also looked at as one wrapped paragraph, which stands at its first line. A
prediction counts if its probability is at least ``least`` and at least ``overlap`` of the n-grams of one
of the family's names, notices, text paragraphs or sentences stand in the paragraph. A wrapped paragraph
counts if none of its lines does by itself. Other lines with a cue word are of the unknown class.

What can't reach the overlap isn't classified, and ``gate`` proves it: each name or paragraph has a set of
words, without all of which less than ``overlap`` of its n-grams are left, so a text with none of these
words has no such paragraph. Everything happens inside a row, without a shuffle, so hot sources and
copies make no difference.

The SQL of the query is that of lines with a cue word and of the names alone; it has the same rows where
no text holds a notice, a licence's own text, a wrapped name or a name without a cue word.

Null and empty texts have no paragraphs. Null ids and repeated rows come back as they are. Extra columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motolake.functions.geometry import let
from motolake.llm.notices import BODIES

# Licence families and the names by which texts refer to them.
FAMILIES = {
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache 2.0 License", "Apache-2.0"],
    "BSD": ["the BSD 3-Clause License", "the BSD 2-Clause License", "the BSD License", "BSD-3-Clause", "BSD-2-Clause"],
    "CC-BY": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "CC-BY-4.0"],
    "CC-BY-NC": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"],
    "CC0": ["the Creative Commons Zero dedication CC0 1.0", "CC0 1.0", "CC0-1.0"],
    "GPL": ["the GNU General Public License, version 3", "the GNU General Public License, version 2", "the GNU GPL v3", "GPL-3.0", "GPL-2.0"],
    "LGPL": ["the GNU Lesser General Public License, version 3", "the GNU LGPL v3", "LGPL-3.0"],
    "MIT": ["the MIT License", "the MIT licence", "MIT"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL-2.0"],
    "proprietary": ["All rights reserved", "Copyright, all rights reserved worldwide"],
}
SENTENCES = ["Released under {}.", "Licensed under {}.", "This work is licensed under {}.", "This software is distributed under the terms of {}.", "This program is free software under {}.", "Available under {}", "SPDX-License-Identifier: {}", "License: {}", "You may use this file under {}; see the LICENSE file."]
UNKNOWN_SENTENCES = [
    "His driving license expired in March.", "The city council refused the license of the bar.", "Copyright law is older than the press.", "A fishing licence costs ten dollars a year.", "They licensed the song to a film studio.", "The university of MIT lies on the river.",
    "An apache helicopter crossed the valley.", "Read the license before you install the program.", "The terms of the agreement follow.", "This work took three years.", "The software is under development.", "Rights of the people are reserved to the states.", "The public library has a general section.",
    "The version of the file is 3.", "Creative people share common ideas.", "All rights come with duties.", "The seats are reserved.", "Distributed systems are hard.", "The clause of the contract was void.", "Free software is a matter of liberty.", "Available in all shops.", "Released in 2004 by a small studio.", "License plates are made here.", "Under the bridge",
]
#: Names without a version, notices and short texts that BODIES lacks, and sentences of all kinds.
MORE_NAMES = {"Apache-2.0": ["the Apache License"], "GPL": ["the GNU General Public License"], "LGPL": ["the GNU Lesser General Public License", "the GNU Library General Public License"], "MPL-2.0": ["the Mozilla Public License"]}
NOTICES = {
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "LGPL": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
}
ORDINARY_SENTENCES = [
    "", "The software is provided to all students of the school.", "Permission to enter was granted by the guard.", "The general public may use the library.", "Ich gehe mit dir unter die Brücke und komme mit dem Zug zurück.", "Die Arbeit mit der Schule ist im Rahmen der Reform neu geordnet.", "Avec la permission de la ville, le public peut entrer.", "La licencia de conducir de mi padre es vieja.",
    "She works at MIT and lives in Boston.", "The Apache people lived in the south.", "The foundation published a free report on the rights of workers.", "You can copy the text and change the names in it.", "The conditions of the contract were met in time.", "The source of the river is in the mountains.", "He gave notice and left the company without a warranty for the car.", "This is one of the works of the author.",
]
#: Words that stand in most texts, in no gate if others do.
COMMON = frozenset(
    "a mit about above after again against all also am an and any are as at be because been before being below between both but by can could did do does doing done down during each either even every few first following for form free from further general had has have having he her here his how i if in include including into is it its "
    "law least less like made make making may me means might more most must my name names neither no nor not notice of off on one only or other our out over own part people person public published read same she should show since so some such system take terms than that the their them then there these they this those "
    "through time to too under until up use used using very was way we were what when where whether which while who whole whom why will with within without work works would you your use see state stated special similar service subject certain business better believed believe author authors automatically attach apply applies anyone allowed additional accompany accompanied widely written unless versions version".split()
)
CUE = r"(?i)licen[cs]e|licensing|copyright|rights reserved|creative commons|\bcc[ -]?(?:by|0)|\bl?gpl\b|\bmpl\b|spdx"
TOKEN = "[a-z0-9]+"


def grams(text: str) -> list[str]:
    words = re.findall(TOKEN, text.lower())
    return list(dict.fromkeys(words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]))


@functools.cache
def model() -> dict:
    """classes, bias, weights by n-gram, and the n-grams of each family's names."""
    classes = [*FAMILIES, "unknown"]
    rows = [(s.format(name), c) for c, names in FAMILIES.items() for name in names for s in (SENTENCES if c != "proprietary" else ["{}.", "© 2020. {}.", "Copyright 2019 by the authors. {}."])]
    rows += [(s, "unknown") for s in UNKNOWN_SENTENCES for _ in range(3)]
    held = [i % 4 == 3 for i in range(len(rows))]
    counts: dict[str, int] = {}
    for (text, _), h in zip(rows, held, strict=True):
        if not h:
            for g in grams(text):
                counts[g] = counts.get(g, 0) + 1
    vocabulary = sorted(g for g, n in counts.items() if n >= 2)
    place = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary)))
    y = np.zeros((len(rows), len(classes)))
    for i, (text, c) in enumerate(rows):
        x[i, [place[g] for g in grams(text) if g in place]] = 1
        y[i, classes.index(c)] = 1
    train = ~np.array(held)
    weight, bias = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
    for _ in range(600):
        z = x[train] @ weight + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d = (p - y[train]) / train.sum()
        weight -= 2.0 * (x[train].T @ d + 1e-4 * weight)
        bias -= 2.0 * d.sum(0)
    z = x[~train] @ weight + bias

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - (s * y[~train]).sum(1)).mean())

    temperature = min(np.geomspace(0.25, 4, 81), key=loss)
    weight, bias = np.round(weight / temperature, 6), np.round(bias / temperature, 6)
    names = {c: [g for g in (grams(n) for n in ns)] for c, ns in FAMILIES.items()}
    return {"classes": classes, "bias": bias.tolist(), "weights": {g: weight[i].tolist() for g, i in place.items()}, "names": names}


def sentences(text: str) -> list[str]:
    """A paragraph and, if there are several, its sentences of 12 words and more."""
    parts = re.split(r"(?<=[.!?])\s+", text)
    return [text, *(p for p in parts if len(parts) > 1 and len(re.findall(TOKEN, p.lower())) >= 12)]


@functools.cache
def full_model() -> dict:
    """As model(), with the licences' notices and texts: classes, bias, weights, and the n-grams of each family's variants.

    A name of one word is one only after a word that the usual sentences have before it.
    """
    classes = [*FAMILIES, "unknown"]
    names = {c: ns + MORE_NAMES.get(c, []) for c, ns in FAMILIES.items()}
    texts = {c: list(dict.fromkeys(NOTICES.get(c, []) + BODIES.get(c, []))) for c in FAMILIES}
    rows = [(s.format(name), c) for c, ns in names.items() for name in ns for s in (SENTENCES if c != "proprietary" else ["{}.", "© 2020. {}.", "Copyright 2019 by the authors. {}."])]
    rows += [(s, "unknown") for s in [*UNKNOWN_SENTENCES, *ORDINARY_SENTENCES] for _ in range(3)] + [("", "unknown")] * 50
    held = [i % 4 == 3 for i in range(len(rows))]
    for c, paragraphs in texts.items():
        for i, text in enumerate(paragraphs):
            words = text.split()
            parts = [*sentences(text), " ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :])]
            rows += [(part, c) for part in parts]
            held += [False] * (len(parts) - 1) + [i % 2 == 1]
    counts: dict[str, int] = {}
    for i, ((text, c), h) in enumerate(zip(rows, held, strict=True)):
        for g in () if h else grams(text):
            counts[g] = counts.get(g, 0) + 1
    usual = set(model()["weights"])
    own = {g for c in ("MIT", "BSD", "CC-BY", "CC-BY-NC", "CC-BY-SA", "CC0") for text in NOTICES.get(c, []) for g in grams(text)}
    vocabulary = sorted(g for g, n in counts.items() if g in usual or n >= 12 or (g in own and n >= 2))
    place = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary)))
    y = np.zeros((len(rows), len(classes)))
    for i, (text, c) in enumerate(rows):
        x[i, [place[g] for g in grams(text) if g in place]] = 1
        y[i, classes.index(c)] = 1
    train = ~np.array(held)
    a, b = np.hstack([x[train], np.ones((train.sum(), 1))]), y[train]
    weight, first, second = (np.zeros((a.shape[1], len(classes))) for _ in range(3))
    for step in range(1, 301):  # Adam: rows are of very different lengths
        z = a @ weight
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d = a.T @ (p - b) / len(a) + 1e-5 * weight
        first, second = 0.9 * first + 0.1 * d, 0.999 * second + 0.001 * d * d
        weight -= 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    z = x[~train] @ weight[:-1] + weight[-1]

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - (s * y[~train]).sum(1)).mean())

    weight = np.round(weight / min(np.geomspace(0.25, 4, 81), key=loss), 6)
    before = list(dict.fromkeys(w for s in SENTENCES for w in re.findall(rf"({TOKEN})[^a-z0-9]+\{{", s.lower())))
    variants = {c: [g for n in ns for g in ([grams(n)] if len(grams(n)) > 1 else [grams(f"{w} {n}") for w in before if w != "the"])] + [grams(t) for p in texts[c] for t in sentences(p)] for c, ns in names.items()}
    return {"classes": classes, "bias": weight[-1].tolist(), "weights": {g: weight[i].tolist() for g, i in place.items()}, "variants": variants}


@functools.cache
def gate(overlap: float) -> str:
    """A regular expression that every lower-case text matches which holds ``overlap`` of the n-grams of a variant.

    Of each variant it has words, without all of which too few n-grams are left, or, where one n-gram can't be missed, that one.
    """
    variants = [v for vs in full_model()["variants"].values() for v in vs]
    use: dict[str, int] = {}
    for v in variants:
        for g in v:
            use[g] = use.get(g, 0) + 1
    usual = set(re.findall(TOKEN, " ".join([*SENTENCES, *ORDINARY_SENTENCES, *UNKNOWN_SENTENCES]).lower()))
    words: set[str] = set()
    pairs: set[str] = set()
    for v in sorted(variants, key=len):
        if (len(v) - 1) / len(v) < overlap:
            pairs.add(max(v, key=len))
            continue
        singles = [g for g in v if " " not in g]
        more = sorted((g for g in singles if g not in words), key=lambda g: (g in COMMON, g.isdigit(), g in usual, len(g) < 7 and len(v) > 20, -use[g], g))
        while sum(not set(g.split()) & words for g in v) / len(v) >= overlap:
            words.add(more.pop(0))

    def trie(rest: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for w in rest:
            heads.setdefault(w[:1], []).append(w[1:])
        out = [h + (trie(t) if h else "") for h, t in sorted(heads.items(), reverse=True)]
        return out[0] if len(out) == 1 else f"(?:{'|'.join(out)})"

    found = [trie(sorted(words)), *(g.replace(" ", "[^a-z0-9]+") for g in sorted(pairs))]
    return f"(?<![a-z0-9])(?:{'|'.join(found)})(?![a-z0-9])"


def strings(values: list[str]) -> Column:
    """A literal array of strings without a line break."""
    return F.split(F.lit("\n".join(values)), "\n")


def runs(lines: Column) -> Column:
    """(start, lines) of the wrapped paragraphs, in order: a line that ends a sentence, or before or without a word, is the last of its own."""
    plain = lambda x: ~x.rlike("[A-Za-z0-9]")
    last = lambda x, i: x.rlike(r"[.!?][\"')\]]*\s*$") | plain(x) | (i + 1 >= F.size(lines)) | plain(F.coalesce(F.get(lines, i + 1), F.lit("")))
    ends = F.filter(F.transform(lines, lambda x, i: F.when(last(x, i), i)), lambda i: i.isNotNull())
    starts = lambda e: F.concat(F.array(F.lit(0)), F.transform(F.slice(e, 1, F.size(e) - 1), lambda i: i + 1))
    return let(ends, lambda e: F.zip_with(starts(e), e, lambda a, b: F.struct(a.alias("start"), F.slice(lines, a + 1, b - a + 1).alias("lines"))))


def paragraph_grams(paragraph: Column) -> Column:
    words = F.regexp_extract_all(F.lower(paragraph), F.lit(f"({TOKEN})"))
    pairs = F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(words, pairs))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, overlap: float = 0.75) -> DataFrame:
    """doc_id, n_paragraphs, licences: array of (paragraph, family, probability, overlap) of each licence found and each other paragraph with a cue word."""
    m = full_model()
    rows = ", ".join("array(" + ", ".join(f"{x!r}D" for x in w) + ")" for w in m["weights"].values())
    table = F.map_from_arrays(strings(list(m["weights"])), F.expr(f"array({rows})"))
    vocabulary = strings(list(m["weights"]))
    bias = F.expr("array(" + ", ".join(f"{x!r}D" for x in m["bias"]) + ")")
    classes = strings(m["classes"])
    known = gate(overlap)
    cued = lambda x: x.rlike(CUE)
    gated = lambda x: F.lower(x).rlike(known)
    unit = lambda i, text, cue, whole: F.struct(i.alias("paragraph"), text.alias("line"), cue.alias("cue"), F.lit(whole).alias("whole"))

    def units(run: Column) -> Column:
        each = F.transform(run["lines"], lambda x, i: unit(run["start"] + i, x, cued(x), False))
        each = F.filter(each, lambda u: u["cue"] | gated(u["line"]))
        whole = F.array(unit(run["start"], F.array_join(run["lines"], " "), F.lit(False), True))
        return F.concat(each, F.when(F.size(run["lines"]) > 1, whole).otherwise(F.slice(whole, 1, 0)))

    def classify(u: Column) -> Column:
        return let(paragraph_grams(u["line"]), lambda g: confirm(u, g, F.aggregate(F.array_intersect(g, vocabulary), bias, lambda acc, x: F.zip_with(acc, table[x], lambda a, b: a + b))))

    def share(found: Column, family: Column, long: bool) -> Column:
        """The largest share of a variant's n-grams; long ones have 20 and more."""
        of = {c: ["\t".join(v) for v in vs if (len(v) >= 20) == long] for c, vs in m["variants"].items()}
        chosen = F.lit(None).cast("array<string>")
        for c, vs in of.items():
            if vs:
                chosen = F.when(family == c, strings(vs)).otherwise(chosen)
        shares = F.transform(chosen, lambda v: let(F.split(v, "\t"), lambda w: F.size(F.array_intersect(found, w)) / F.size(w)))
        return F.coalesce(F.array_max(shares), F.lit(0.0))

    def confirm(u: Column, found: Column, logits: Column) -> Column:
        def verdict(z: Column) -> Column:
            top = F.array_max(z)
            family = F.element_at(classes, F.array_position(z, top).cast("int"))
            probability = 1 / F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
            return F.struct(family.alias("family"), probability.alias("probability"))

        def result(v: Column) -> Column:
            return let(F.struct(share(found, v["family"], False).alias("short"), share(found, v["family"], True).alias("long")), lambda o: F.struct(u["paragraph"].alias("paragraph"), F.when((v["probability"] >= least) & (F.greatest(o["short"], o["long"]) >= overlap), v["family"]).otherwise("unknown").alias("family"), v["probability"].alias("probability"), F.greatest(o["short"], o["long"]).alias("overlap"), (o["long"] >= overlap).alias("long"), u["cue"].alias("cue"), u["whole"].alias("whole")))

        return let(let(logits, verdict), result)

    def settle(run: Column) -> Column:
        """A wrapped paragraph counts if no line of it does; the cue words of one that is a notice, or counts, are its own."""
        own = F.filter(run, lambda u: ~u["whole"] & (u["family"] != "unknown"))
        whole = F.filter(run, lambda u: u["whole"] & (u["family"] != "unknown"))
        wrapped = F.when(F.size(own) == 0, whole).otherwise(F.slice(whole, 1, 0))
        covers = (F.size(whole) > 0) & ((F.size(own) == 0) | F.coalesce(F.get(whole, F.lit(0))["long"], F.lit(False)))
        others = F.filter(run, lambda u: ~u["whole"] & (u["family"] == "unknown") & u["cue"] & ~covers)
        return F.concat(wrapped, own, others)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.split(text, "\n")
    all_runs = let(lines, runs)
    near = F.filter(all_runs, lambda r: let(F.array_join(r["lines"], " "), lambda x: cued(x) | gated(x)))
    found = F.when(cued(text) | gated(text), near).otherwise(F.array().cast("array<struct<start:int,lines:array<string>>>"))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.size(F.filter(lines, lambda x: F.length(F.trim(x)) > 0)).cast("long").alias("n_paragraphs"), found.alias("runs"))
    out = out.withColumn("runs", F.transform("runs", lambda r: F.transform(units(r), classify)))
    licences = F.array_sort(F.flatten(F.transform("runs", settle)))
    return out.select("doc_id", "n_paragraphs", F.transform(licences, lambda p: F.struct(*(p[c].alias(c) for c in ("paragraph", "family", "probability", "overlap")))).alias("licences"))


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    known = F.filter("licences", lambda x: x["family"] != "unknown")
    names = F.array_join(F.array_sort(F.array_distinct(F.transform(known, lambda x: x["family"]))), ",")
    return found.select("doc_id", "n_paragraphs", F.size(known).cast("long").alias("n_licences"), (F.size("licences") - F.size(known)).cast("long").alias("n_unknown"), names.alias("families"))


def oracle_sql(least: float = 0.5, overlap: float = 0.75) -> str:
    m = model()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    weights = ", ".join(f"({quote(g)}, {quote(c)}, CAST({x!r} AS DOUBLE))" for g, w in m["weights"].items() for c, x in zip(m["classes"], w, strict=True) if x)
    bias = ", ".join(f"({quote(c)}, CAST({b!r} AS DOUBLE))" for c, b in zip(m["classes"], m["bias"], strict=True))
    names = ", ".join(f"({quote(c)}, {i}, {quote(g)})" for c, vs in m["names"].items() for i, v in enumerate(vs) for g in v)
    cue = CUE.replace("'", "''")
    return f"""
WITH w(gram, family, weight) AS (VALUES {weights}),
b(family, bias) AS (VALUES {bias}),
n(family, variant, gram) AS (VALUES {names}),
sizes AS (SELECT family, variant, count(*) AS size FROM n GROUP BY ALL),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
cued AS (SELECT doc_id, i, regexp_extract_all(lower(line), '{TOKEN}') AS words FROM lines WHERE regexp_matches(line, '{cue}')),
grams AS (
  SELECT DISTINCT doc_id, i, unnest(list_concat(words, list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1]))) AS gram FROM cued),
logits AS (
  SELECT c.doc_id, c.i, b.family, b.bias + coalesce(sum(w.weight), 0) AS logit
  FROM (SELECT DISTINCT doc_id, i FROM cued) c CROSS JOIN b
  LEFT JOIN grams g ON g.doc_id = c.doc_id AND g.i = c.i LEFT JOIN w ON w.gram = g.gram AND w.family = b.family
  GROUP BY c.doc_id, c.i, b.family, b.bias),
best AS (SELECT doc_id, i, arg_max(family, logit) AS family, 1 / sum(exp(logit - top)) AS probability FROM (SELECT *, max(logit) OVER (PARTITION BY doc_id, i) AS top FROM logits) GROUP BY doc_id, i),
shares AS (
  SELECT doc_id, i, max(share) AS share FROM (
    SELECT best.doc_id, best.i, n.variant, count(*) / any_value(sizes.size) AS share
    FROM best JOIN n ON n.family = best.family JOIN sizes ON sizes.family = n.family AND sizes.variant = n.variant
    JOIN grams g ON g.doc_id = best.doc_id AND g.i = best.i AND g.gram = n.gram GROUP BY best.doc_id, best.i, n.variant) GROUP BY doc_id, i),
verdicts AS (
  SELECT best.doc_id, CASE WHEN probability >= {least} AND coalesce(share, 0) >= {overlap} THEN family ELSE 'unknown' END AS family FROM best LEFT JOIN shares ON shares.doc_id = best.doc_id AND shares.i = best.i),
found AS (
  SELECT doc_id, count(*) FILTER (family <> 'unknown') AS n_licences, count(*) FILTER (family = 'unknown') AS n_unknown,
    array_to_string(list_sort(list(DISTINCT family) FILTER (family <> 'unknown')), ',') AS families FROM verdicts GROUP BY doc_id),
paragraphs AS (SELECT doc_id, count(*) FILTER (length(trim(line, ' ')) > 0) AS n_paragraphs FROM lines GROUP BY doc_id)
SELECT p.doc_id, CAST(p.n_paragraphs AS BIGINT) AS n_paragraphs, CAST(coalesce(n_licences, 0) AS BIGINT) AS n_licences, CAST(coalesce(n_unknown, 0) AS BIGINT) AS n_unknown, coalesce(families, '') AS families
FROM paragraphs p LEFT JOIN found USING (doc_id)
"""

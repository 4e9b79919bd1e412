"""Licence scan by a trained paragraph classifier (DataFrame operations only).

A paragraph is a line, or a run of words over several lines (see below).  Its features are runs of one to three words, hashed into ``BUCKETS``; a sparse
(L1) multinomial logistic regression gives each licence family and the class ``unknown`` a
probability.  It is fitted on the driver from variants of the fixed templates below and from a
bounded sample of the corpus's own lines as ``unknown``.  Its temperature is calibrated on held-out
variants and lines.  A predicted family is confirmed when enough of one of its templates' word pairs
stand in the paragraph.

Scoring is one projection without a shuffle: the weights are arrays indexed by bucket.  Only lines
with a word that is a feature of its own go on to the runs; a line without any such word has the score
of an empty one, which is ``unknown``, as runs are features only where one of their words is.

Notices wrapped over lines: the words of all lines are one sequence, whatever the breaks, comment marks and
blank lines between them.  Wherever enough of a template's word pairs stand within the template's length of
each other, on more than one line, the run from the first to the last of them is classified like a line,
and it is a notice if the family is the template's.  Every template has a gate, pairs of which any such run
holds at least one, so only the surroundings of such pairs are compared.

Sample bound: the lines of the ``BACKGROUND_DOCS`` documents with the smallest hash, at most
``BACKGROUND_LINES`` of them.  A null text is empty and has no notices; repeated rows get equal
results; an empty table gives no rows; an id may be null.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text

UNKNOWN = "unknown"
# Notices and sentences by which licences are recognised.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0"],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only"],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0."],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0 Universal.",
        "This work has been dedicated to the public domain."],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 the authors. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium is strictly prohibited. Proprietary and confidential."],
}
FAMILIES = [*TEMPLATES, UNKNOWN]
BUCKETS = 1 << 14
LONGEST_GRAM = 3
BACKGROUND_DOCS, BACKGROUND_LINES = 500, 4000
VARIANTS = 12
# A word of a template is a feature of its own if at most this share of background lines has it.
COMMON = 0.002
ROUNDS, RATE, L1 = 200, 0.5, 2e-5
# Least probability of a family, and least share of a template's word pairs, of a notice.
LIKELY, CONTAINED = 0.5, 0.6
_NOT_WORD = r"[^a-z0-9.+-]+"


@dataclass(frozen=True)
class Classifier:
    """``words`` that are features by themselves; ``weights[family][bucket]``, already divided by the temperature."""

    words: list[str]
    weights: list[list[float]]
    bias: list[float]


def words_of(text: Column) -> Column:
    """Lower-case words; dots, pluses and hyphens inside stay, dots at the end go."""
    return F.filter(F.transform(F.split(F.lower(text), _NOT_WORD), lambda w: F.rtrim(w, F.lit(".-"))), lambda w: w != "")


def grams_of(words: Column, n: int) -> Column:
    """Runs of ``n`` words, one space apart."""
    if n == 1:
        return words
    many = F.greatest(F.size(words) - (n - 1), F.lit(0))
    starts = F.slice(words, F.lit(1), many)
    return F.transform(starts, lambda _, i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))


def bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _constant(values, kind: str) -> Column:
    """An array as one constant of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _variants(rng: random.Random, background: list[str]) -> list[tuple[str, int]]:
    """Templates as they occur: whole, in part, with words missing, or inside other text."""
    filler = [w for line in background for w in line.split()] or ["text"]
    out = []
    for k, family in enumerate(TEMPLATES):
        for text in TEMPLATES[family]:
            words = text.split()
            out += [(text, k)] * 3
            for _ in range(VARIANTS):
                kept = [w for w in words if rng.random() > 0.1] or words
                if len(kept) > 8 and rng.random() < 0.4:
                    at = rng.randrange(len(kept) // 3)
                    kept = kept[at:at + 2 * len(kept) // 3]
                before = [rng.choice(filler) for _ in range(rng.choice((0, 0, 2, 6)))]
                after = [rng.choice(filler) for _ in range(rng.choice((0, 0, 2, 6)))]
                line = " ".join([*before, *kept, *after])
                out.append((rng.choice((line, line, line.upper(), "# " + line)), k))
    # Lines that only speak of such things are unknown.
    out += [(t, len(TEMPLATES)) for t in ("See the license file.", "license", "the version of the file", "copyright",
                                           "a driver license is required", "software version 2.0", "permission denied",
                                           "the public domain", "all rights", "under the terms of the agreement") for _ in range(6)]
    return out


def _fit(rows: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by proximal gradient steps with momentum: weights by bucket and family, biases."""
    kinds, at = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    order = np.argsort(at, kind="stable")
    heads = np.searchsorted(at[order], np.arange(len(kinds)))
    starts = np.searchsorted(owner, np.arange(len(rows)))
    norm = 1 / np.sqrt(np.bincount(owner, minlength=len(rows)).clip(1))[owner][:, None]
    target = np.eye(len(FAMILIES))[classes]
    # Half of the weight is unknown, as most lines are; the families share the rest.
    part = np.append(np.full(len(TEMPLATES), 0.5 / len(TEMPLATES)), 0.5)
    share = (part / np.bincount(classes, minlength=len(FAMILIES)).clip(1))[classes][:, None]
    w, b = np.zeros((len(kinds), len(FAMILIES))), np.zeros(len(FAMILIES))
    ahead, last = w, w
    for step in range(1, ROUNDS + 1):
        logits = np.add.reduceat(ahead[at] * norm, starts, axis=0) + b
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = (p - target) * share
        gradient = np.add.reduceat((slope[owner] * norm)[order], heads, axis=0)
        w = ahead - RATE * 20 * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * 20 * L1, 0)
        b = b - RATE * 20 * slope.sum(axis=0)
        ahead, last = w + (step - 1) / (step + 2) * (w - last), w
    weights = np.zeros((BUCKETS, len(FAMILIES)))
    weights[kinds] = w
    return weights, b


def _log_loss(rows, classes, weights, bias, temperature: float) -> float:
    logits = np.array([weights[r].sum(axis=0) / np.sqrt(max(len(r), 1)) + bias for r in rows]) / temperature
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    return float(-np.log(p[np.arange(len(rows)), classes] / p.sum(axis=1)).mean())


def _contained(words: Column, pairs: Column) -> Column:
    """Share of a template's word pairs that stand among the words."""
    return F.size(F.array_intersect(pairs, grams_of(words, 2))) / F.size(pairs)


def _templates(spark) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    frame = spark.createDataFrame(rows, "family string, text string").withColumn("words", words_of(F.col("text")))
    return frame.withColumn("pairs", F.array_distinct(grams_of(F.col("words"), 2)))


def fit(docs: DataFrame, seed: int = 7) -> Classifier:
    """Fit and calibrate the classifier; the corpus gives the background lines."""
    spark = docs.sparkSession
    text = id_and_text(docs).orderBy(F.xxhash64("doc_id", "text")).limit(BACKGROUND_DOCS)
    lines = text.select(F.explode(F.split("text", "\n")).alias("line")).filter(F.length(F.trim("line")) > 0)
    lines = lines.orderBy(F.xxhash64("line")).limit(BACKGROUND_LINES)
    pairs = [set(r["pairs"]) for r in _templates(spark).select("pairs").collect()]
    sample = [(r["line"], r["words"]) for r in lines.select("line", words_of(F.col("line")).alias("words")).collect()]

    def foreign(words: list[str]) -> bool:
        """Whether a line already holds much of a template, and so is no background."""
        own = set(map(" ".join, zip(words, words[1:])))
        return any(len(own & p) >= max(1, CONTAINED / 2 * len(p)) for p in pairs)

    background = [line for line, words in sample if not foreign(words)]
    rng = random.Random(seed)
    labelled = _variants(rng, background) + [(line, len(TEMPLATES)) for line in background]
    frame = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(labelled)], "no bigint, line string, class int")
    rows = frame.select("no", "class", words_of(F.col("line")).alias("words")).collect()
    seen = Counter(w for r in rows if r["class"] == len(TEMPLATES) for w in set(r["words"]))
    wanted = Counter(w for r in _templates(spark).select("words").collect() for w in set(r["words"]))
    limit = max(COMMON * max(len(background), 1), 12)
    rare = sorted(w for w in wanted if seen[w] <= limit)
    grams = {r["no"]: {" ".join(r["words"][i:i + n]) for n in range(1, LONGEST_GRAM + 1) for i in range(len(r["words"]) - n + 1)
                       if not set(rare).isdisjoint(r["words"][i:i + n])} for r in rows}
    known = sorted(set().union(*grams.values(), rare))
    hashed = spark.createDataFrame([(g,) for g in known], "gram string").select("gram", bucket(F.col("gram")).alias("b")).collect()
    place = {r["gram"]: r["b"] for r in hashed}
    features = [np.array(sorted(place[g] for g in grams[r["no"]]) or [0], np.int64) for r in rows]
    classes = np.array([r["class"] for r in rows])
    held = np.array([r["no"] % 5 == 0 for r in rows])
    weights, bias = _fit([f for f, h in zip(features, held) if not h], classes[~held])
    scale = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: _log_loss(
        [f for f, h in zip(features, held) if h], classes[held], weights, bias, t)) if held.any() else 1.0
    return Classifier(rare, np.round(weights.T / scale, 5).tolist(), (bias / scale).tolist())


def scored(units: Column, model: Classifier, *carried: str) -> Column:
    """The units that may be notices, those with a word that is a feature of its own, with ``family, probability``.

    ``units`` is an array of structs with ``words`` and the fields ``carried``.
    """
    weights = [_constant(w, "double") for w in model.weights]

    def also(s: Column, **fields: Column) -> Column:
        return F.struct(*[s[c].alias(c) for c in (*carried, "words")], *[v.alias(k) for k, v in fields.items()])

    def features(words: Column, has: Column) -> Column:
        runs = F.flatten(F.array(*[
            F.transform(F.filter(F.sequence(F.lit(1), F.size(words)),
                                 lambda i: (i + (n - 1) <= F.size(words)) & F.array_contains(F.slice(has, i, F.lit(n)), True)),
                        lambda i: F.array_join(F.slice(words, i, F.lit(n)), " ")) for n in range(1, LONGEST_GRAM + 1)]))
        return F.transform(F.array_distinct(runs), bucket)

    def logit(found: Column, k: int) -> Column:
        total = F.aggregate(found, F.lit(0.0), lambda s, i: s + weights[k][i])
        return total / F.sqrt(F.greatest(F.size(found), F.lit(1))) + F.lit(model.bias[k])

    units = F.filter(units, lambda s: F.exists(s["words"], lambda w: w.isin(*model.words)))
    units = F.transform(units, lambda s: also(s, has=F.transform(s["words"], lambda w: w.isin(*model.words))))
    units = F.transform(units, lambda s: also(s, found=features(s["words"], s["has"])))
    units = F.transform(units, lambda s: also(s, logits=F.array(*[logit(s["found"], k) for k in range(len(FAMILIES))])))

    def judged(s: Column) -> Column:
        top = F.array_max(s["logits"])
        family = F.array(*map(F.lit, FAMILIES))[F.array_position(s["logits"], top).cast("int") - 1]
        total = F.aggregate(s["logits"], F.lit(0.0), lambda n, x: n + F.exp(x - top))
        return also(s, family=family, probability=1 / total)

    return F.transform(units, judged)


def _gate(pairs: list[str]) -> list[str]:
    """Pairs of a template, the longest ones, of which every run that holds enough of the template has one."""
    need = next(m for m in range(1, len(pairs) + 1) if m / len(pairs) >= CONTAINED)
    return sorted(pairs, key=lambda p: (-len(p), p))[:len(pairs) - need + 1]


def _notice(paragraph: Column, last_line: Column, family: Column, probability: Column, contained: Column) -> Column:
    return F.struct(paragraph.cast("bigint").alias("paragraph"), last_line.cast("bigint").alias("last_line"), family.alias("family"),
                    F.round(probability, 6).alias("probability"), F.round(contained, 6).alias("contained"),
                    (contained >= CONTAINED).alias("confirmed"))


def _runs(hits: Column, words: Column, lines: Column, templates: Column, gate: list[str], longest: int) -> Column:
    """Runs of words over several lines that hold enough of a template: ``wanted, contained, paragraph, last_line, words``.

    ``hits`` are the word pairs of templates in the document with their places, ``words`` all its words and
    ``lines`` their lines.  A run is looked for around every hit of a gate, as far as the template is long; of a
    pair that stands there several times the nearest one counts.
    """
    seeds = F.filter(F.transform(hits, lambda h, k: F.struct(k.alias("k"), h["pos"].alias("pos"), h["pair"].alias("pair"))),
                     lambda s: s["pair"].isin(*gate))

    def around(s: Column, t: Column) -> Column:
        close = F.slice(hits, F.greatest(s["k"] + (1 - longest), F.lit(1)), F.lit(2 * longest + 1))
        return F.struct(t["family"].alias("wanted"), t["pairs"].alias("pairs"), s["pos"].alias("pos"),
                        F.filter(close, lambda h: F.abs(h["pos"] - s["pos"]) <= t["length"]).alias("near"))

    def nearest(c: Column) -> Column:
        places = F.transform(c["pairs"], lambda x: F.array_min(F.transform(
            F.filter(c["near"], lambda h: h["pair"] == x),
            lambda h: F.struct(F.abs(h["pos"] - c["pos"]).alias("far"), h["pos"].alias("pos"))))["pos"])
        return F.struct(c["wanted"].alias("wanted"), F.size(c["pairs"]).alias("all"),
                        F.filter(places, lambda p: p.isNotNull()).alias("places"))

    found = F.flatten(F.transform(seeds, lambda s: F.transform(
        F.filter(templates, lambda t: F.array_contains(t["gate"], s["pair"])), lambda t: around(s, t))))
    found = F.filter(F.transform(found, nearest), lambda c: F.size(c["places"]) / c["all"] >= CONTAINED)
    found = F.transform(found, lambda c: F.struct(
        c["wanted"].alias("wanted"), (F.size(c["places"]) / c["all"]).alias("contained"),
        F.array_min(c["places"]).alias("start"), (F.array_max(c["places"]) + 1).alias("stop")))
    found = F.filter(F.array_distinct(found), lambda c: F.get(lines, c["start"]) < F.get(lines, c["stop"]))
    return F.transform(found, lambda c: F.struct(
        c["wanted"].alias("wanted"), c["contained"].alias("contained"), F.get(lines, c["start"]).alias("paragraph"),
        F.get(lines, c["stop"]).alias("last_line"), F.slice(words, c["start"] + 1, c["stop"] - c["start"] + 1).alias("words")))


def find_notices(docs: DataFrame, model: Classifier | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``notices`` of every document.

    A notice has ``paragraph, last_line`` (lines from 0), ``family, probability, contained, confirmed``.  Those of one
    line may be unconfirmed; a notice over several lines is confirmed, and has no confirmed line of its family inside.
    """
    model = model or fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    rows = [r for r in _templates(docs.sparkSession).collect() if r["pairs"]]
    templates = F.array(*[
        F.struct(F.lit(r["family"]).alias("family"), F.lit(len(r["words"])).alias("length"),
                 F.array(*map(F.lit, r["pairs"])).alias("pairs"), F.array(*map(F.lit, _gate(r["pairs"]))).alias("gate")) for r in rows])
    known, pairs = sorted({w for r in rows for w in r["words"]}), sorted({p for r in rows for p in r["pairs"]})
    gate, longest = sorted({p for r in rows for p in _gate(r["pairs"])}), max(len(r["words"]) for r in rows)

    def compared(s: Column) -> Column:
        own = F.filter(templates, lambda t: t["family"] == s["family"])
        best = F.array_max(F.transform(own, lambda t: _contained(s["words"], t["pairs"])))
        return _notice(s["paragraph"], s["paragraph"], s["family"], s["probability"], best)

    def hit(word: Column, i: Column) -> Column:
        after = F.get("words", i + 1)
        return F.when(word.isin(*known) & after.isin(*known), F.struct(i.alias("pos"), F.concat_ws(" ", word, after).alias("pair")))

    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("paragraph"), words_of(line).alias("words")))
    likely = F.filter(scored(F.col("lines"), model, "paragraph"), lambda s: (s["family"] != UNKNOWN) & (s["probability"] >= LIKELY))
    # Lines without words, blank or only marks of a comment, do not part the lines around them.
    flat = id_and_text(docs, id_col, text_col).select("doc_id", lines.alias("lines")).select(
        "doc_id", F.transform(likely, compared).alias("single"), F.flatten(F.transform("lines", lambda s: s["words"])).alias("words"),
        F.flatten(F.transform("lines", lambda s: F.array_repeat(s["paragraph"], F.size(s["words"])))).alias("at"))
    hits = flat.select("*", F.filter(F.transform("words", hit), lambda h: h.isNotNull() & h["pair"].isin(*pairs)).alias("hits"))
    runs = scored(_runs(F.col("hits"), F.col("words"), F.col("at"), templates, gate, longest), model,
                  "wanted", "contained", "paragraph", "last_line")
    runs = F.filter(runs, lambda s: (s["family"] == s["wanted"]) & (s["probability"] >= LIKELY))
    several = F.array_sort(F.transform(runs, lambda s: _notice(
        s["paragraph"], s["last_line"], s["family"], s["probability"], s["contained"])))
    found = hits.select("doc_id", "single", several.alias("several"))

    def own(n: Column, i: Column) -> Column:
        """The notice, if it is the last of its lines and family and no line of it is a notice by itself."""
        after = F.get("several", i + 1)
        repeated = F.coalesce((after["paragraph"] == n["paragraph"]) & (after["last_line"] == n["last_line"])
                              & (after["family"] == n["family"]), F.lit(False))
        inside = F.exists("single", lambda s: s["confirmed"] & (s["family"] == n["family"])
                          & s["paragraph"].between(n["paragraph"], n["last_line"]))
        return F.when(~repeated & ~inside, n)

    several = F.filter(F.transform("several", own), lambda n: n.isNotNull())
    return found.select("doc_id", F.array_sort(F.concat("single", several)).alias("notices"))


def summary(found: DataFrame) -> DataFrame:
    """``doc_id, n_notices, n_confirmed, families`` (of confirmed notices, sorted, comma-joined) and ``notices``."""
    sure = F.filter("notices", lambda n: n["confirmed"])
    return found.select("doc_id", F.size("notices").cast("bigint").alias("n_notices"), F.size(sure).cast("bigint").alias("n_confirmed"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda n: n["family"]))), ",").alias("families"),
                        "notices")

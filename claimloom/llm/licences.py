"""Licence scan: a trained paragraph classifier in DataFrame functions alone.

A multinomial logistic regression over word unigrams and bigrams, sparse by its L1
penalty, names the licence family of a paragraph or none. A paragraph ends at a blank line,
and at a line feed after the end of a sentence; other line feeds are wraps, so a notice that
is set over several lines is judged as a whole. The model is trained
in numpy on the driver from the notices and names below, whole, shortened, misspelt and set among
other words, against paragraphs that use the same words for other things. Its
probabilities are calibrated on paragraphs that training has not seen: a temperature,
and the least threshold at which at most ``FALSE_RATE`` of the other paragraphs would be
named; below it the answer is ``unknown``. A named family is confirmed when the paragraph
holds enough of the n-grams of one of the family's notices.

Scoring is row by row and shuffles nothing. Every n-gram with a weight has a word that is
not a stop word, so a paragraph without any of those words scores as unknown; documents
and paragraphs are passed over by that test first, which changes no result.

Defined results: a null or empty text has no licence and gives no row; repeated rows give
their rows once each; null ``doc_id`` rows are kept; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FALSE_RATE = 0.002
CONFIRMED = 0.55
#: The bound of the generated training paragraphs, and of those that calibrate.
TRAINING, CALIBRATION = 3000, 3000
#: Where paragraphs end; the line feed stands first, so that nothing is looked back over elsewhere.
BREAK = r"\n(?<=[.!?:;][\"')\]]{0,2}[ \t\r]{0,8}\n)|\n[ \t\r]*\n\s*"
UNKNOWN = "unknown"
_WORD = r"[a-z]+|[0-9]+(?:[.][0-9]+)*"

# Notices by family.
NOTICES: tuple[tuple[str, str], ...] = (
    ("mit", "Released under the MIT License."),
    ("mit", "This software is licensed under the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("gpl", "Licensed under the GPL v2 or later."),
    ("lgpl", "This library is distributed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Distributed under the 3-clause BSD License."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "SPDX-License-Identifier: MPL-2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Text is available under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "Released under CC0 1.0, dedicated to the public domain."),
    ("cc0", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("proprietary", "Copyright. All rights reserved. No part of this work may be reproduced without written permission."),
    ("mit", "The MIT License (MIT)"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("apache", "The Apache 2.0 License"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program. If not, see the address below."),
    ("gpl", "The GNU GPL v3"),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the foundation."),
    ("lgpl", "The GNU LGPL v2.1"),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program. If not, see the address below."),
    ("agpl", "The GNU AGPL v3"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("bsd", "This code is governed by a BSD-style license."),
    ("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at the address below."),
    ("mpl", "Mozilla Public License Version 2.0"),
    ("cc-by", "Creative Commons Attribution (CC BY) license"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike (CC BY-SA) license"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial (CC BY-NC) license"),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication"),
    ("isc", "The ISC License"),
    ("proprietary", "Confidential and proprietary. Unauthorized copying, via any medium, is strictly prohibited."),
)
# Sentences that name a licence, around its short name.
FRAMES: tuple[str, ...] = (
    "Licensed under the {}.", "This project is licensed under the terms of the {}.", "Released under {}, see the file for details.", "Distributed under the {} by its authors.",
    "The code is made available under the {}.", "Governed by the {} that can be found in the root.", "Published under the {} terms.", "You may use it under {} only.", "Shared as {}.",
)
# Short names by family, as sentences use them.
NAMES: tuple[tuple[str, str], ...] = (
    ("mit", "MIT license"), ("mit", "MIT-style license"), ("apache", "Apache License 2.0"), ("apache", "Apache 2.0 license"), ("apache", "Apache License, Version 2.0"),
    ("gpl", "GNU General Public License"), ("gpl", "GPL version 3"), ("gpl", "GPLv2"), ("lgpl", "GNU Lesser General Public License"), ("lgpl", "LGPL"),
    ("agpl", "GNU Affero General Public License"), ("agpl", "AGPL"), ("bsd", "BSD license"), ("bsd", "2-clause BSD license"), ("mpl", "Mozilla Public License 2.0"), ("mpl", "MPL"),
    ("cc-by", "CC BY 4.0"), ("cc-by", "Creative Commons Attribution License"), ("cc-by-sa", "CC BY-SA 4.0"), ("cc-by-sa", "Creative Commons Attribution-ShareAlike License"),
    ("cc-by-nc", "CC BY-NC 4.0"), ("cc-by-nc", "Creative Commons Attribution-NonCommercial License"), ("cc0", "CC0"), ("cc0", "public domain dedication CC0 1.0"), ("isc", "ISC license"),
)
# Paragraphs that are no notices, though they share words with them.
OTHERS: tuple[str, ...] = (
    "He lost his driver's license on the road to the public library.",
    "The version released this year is free for any person with a copy.",
    "Poetic license lets the writer modify the source of the work.",
    "The Apache people lived in the south and used the following paths.",
    "A general of the army gave the public written permission to use the road.",
    "The software has a file for source code and documentation.",
    "Common creative work is subject to the terms of the school.",
    "A gnu is an animal with a free and general way of life.",
    "Version 2.0 of the program fixes an error in the binary form.",
    "The foundation published a later edition under the same terms.",
    "All rights of the person are reserved by law in the state.",
    "Students at MIT study software and distribute the results.",
    "The domain of the function is public and the form is binary.",
    "We released the birds under the bridge, free of charge.",
    "The clause in the contract permits redistribution of income.",
    "Attribution of the painting to the master is disputed, international experts say.",
    "The license fee for the television was granted for 4.0 years.",
    "Mozilla and other companies distribute a browser.",
    "Er kam mit dem Zug und mit der Familie in die Stadt.",
    "Das Haus mit der Version 2.0 steht dort, mit Garten.",
    "The mit on the left hand was lost.",
)
#: Notices of which a third of the words, in no order, names nothing.
LONG = tuple(n for _, n in NOTICES if len(n.split()) >= 10)
STOP_WORDS = frozenset("a all an and any are as at be by for from has he his in into is it its may no not of on only or part that the this to under was way we with without you can".split())


def words_of(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


def grams_of(text: str) -> list[str]:
    words = words_of(text)
    return list(dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]))


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]  # the classes but the last, which is unknown
    grams: tuple[str, ...]
    weights: np.ndarray  # grams x classes
    bias: np.ndarray
    temperature: float
    threshold: float
    held: np.ndarray  # grams x notices: 1 if the notice holds the n-gram
    anchors: tuple[str, ...]

    def scores(self, text: str) -> np.ndarray:
        at = {g: n for n, g in enumerate(self.grams)}
        own = [at[g] for g in grams_of(text) if g in at]
        z = (self.bias + self.weights[own].sum(axis=0)) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def scan(self, text: str) -> tuple[str, float, float]:
        """Family, its probability and its notices' best agreement: the plain form of ``scan``."""
        p = self.scores(text)
        best = int(p.argmax())
        if best == len(self.families) or p[best] < self.threshold:
            return UNKNOWN, float(p[best]), 0.0
        grams = set(grams_of(text))
        own = np.array([g in grams for g in self.grams], float) @ self.held
        share = [own[n] / self.held[:, n].sum() for n, (f, _) in enumerate(NOTICES) if f == self.families[best]]
        return self.families[best], float(p[best]), float(max(share))


def _paragraphs(rng: np.random.Generator, count: int, families: tuple[str, ...], filler: list[str]) -> tuple[list[str], np.ndarray]:
    texts, labels = [], []
    for _ in range(count):
        around = [str(w) for w in rng.choice(filler, int(rng.integers(0, 40)))]
        kind = rng.random()
        if kind < 0.55:
            if rng.random() < 0.35:
                family, name = NAMES[int(rng.integers(len(NAMES)))]
                notice = FRAMES[int(rng.integers(len(FRAMES)))].format(name)
            else:
                family, notice = NOTICES[int(rng.integers(len(NOTICES)))]
            words = notice.split()
            keep = rng.random(len(words)) > rng.choice([0, 0, 0.05, 0.15])
            words = [w for w, k in zip(words, keep, strict=True) if k]
            if rng.random() < 0.4:
                around = []
        else:
            family = UNKNOWN
            source = OTHERS[int(rng.integers(len(OTHERS)))] if kind < 0.8 else LONG[int(rng.integers(len(LONG)))] if kind < 0.9 else ""
            words = source.split()
            if 0.8 <= kind < 0.9:  # the words of a notice in no order, thinned
                words = [str(w) for w in rng.permutation(words)[: max(1, len(words) // 3)]]
                around += [str(w) for w in rng.choice(filler, 12)]
                around = [str(w) for w in rng.permutation(around + words)]
                words = []
        at = int(rng.integers(len(around) + 1))
        texts.append(" ".join([*around[:at], *words, *around[at:]]))
        labels.append(families.index(family) if family != UNKNOWN else len(families))
    return texts, np.array(labels)


@lru_cache(maxsize=1)
def trained(seed: int = 5) -> Model:
    """The model, trained anew in each driver process, in some seconds."""
    rng = np.random.default_rng(seed)
    families = tuple(dict.fromkeys(f for f, _ in NOTICES))
    grams = [g for g in dict.fromkeys(g for n in [*(n for _, n in NOTICES), *(n for _, n in NAMES)] for g in grams_of(n)) if not STOP_WORDS.issuperset(g.split())]
    at = {g: n for n, g in enumerate(grams)}
    filler = [w for o in OTHERS for w in o.split()] + [f"{a}{b}" for a in ("ta", "re", "mon", "sil") for b in ("ver", "do", "ning", "la")] * 6

    def matrix(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(grams)), np.float32)
        for n, text in enumerate(texts):
            out[n, [at[g] for g in grams_of(text) if g in at]] = 1
        return out

    texts, y = _paragraphs(rng, TRAINING, families, filler)
    x, classes = matrix(texts), len(families) + 1
    target = np.eye(classes)[y]
    w, b, penalty = np.zeros((len(grams), classes), np.float32), np.zeros(classes), 2e-4
    b[-1] = 1
    speed, m = 6.0, np.zeros_like(w)
    for _ in range(300):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        m = 0.8 * m + x.T @ (p - target).astype(np.float32) / len(x)
        w -= speed * 0.2 * m
        b -= speed * 0.2 * (p - target).mean(axis=0)
        w = np.sign(w) * np.maximum(np.abs(w) - speed * 0.2 * penalty, 0)  # L1
    # Calibration on paragraphs of its own.
    texts, y = _paragraphs(rng, CALIBRATION, families, filler)
    z = matrix(texts) @ w + b

    def probabilities(temperature: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return e / e.sum(axis=1, keepdims=True)

    temperature = min(np.linspace(0.3, 3, 28), key=lambda t: -np.log(probabilities(t)[np.arange(len(y)), y] + 1e-12).mean())
    p = probabilities(temperature)
    named = np.where(p.argmax(axis=1) < classes - 1, p[:, :-1].max(axis=1), 0)[y == classes - 1]
    threshold = float(max(0.5, np.quantile(named, 1 - FALSE_RATE)))
    used = np.flatnonzero(np.abs(w).sum(axis=1))
    held = np.array([[g in set(grams_of(n)) for _, n in NOTICES] for g in grams], float)
    anchors = sorted({v for g in grams for v in g.split()} - STOP_WORDS)
    keep = sorted(set(used.tolist()) | set(np.flatnonzero(held.sum(axis=1)).tolist()))
    return Model(families, tuple(grams[k] for k in keep), np.round(w[keep].astype(np.float64), 6), np.round(b, 6), float(temperature), threshold, held[keep], tuple(anchors))


def _literal(value: object, kind: str) -> Column:
    """A constant of a nested type, which the optimizer folds into the plan once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, paragraph (number from 0), family, probability, similarity and confirmed, for paragraphs that name a licence."""
    model = model or trained()
    classes, notices = len(model.families) + 1, len(NOTICES)
    anchors = _literal(list(model.anchors), "array<string>")
    sizes = np.maximum(model.held.sum(axis=0), 1)
    vectors = np.concatenate([model.weights, np.round(model.held / sizes, 9)], axis=1)
    table = F.map_from_arrays(_literal(list(model.grams), "array<string>"), _literal(vectors.tolist(), "array<array<double>>"))
    start = _literal([*model.bias.tolist(), *[0.0] * notices], "array<double>")

    anchored = lambda c: F.arrays_overlap(F.split(F.lower(c), "[^a-z]+"), anchors)
    lines = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .filter(anchored(F.col("text")))
        .select("doc_id", F.posexplode(F.split("text", BREAK, -1)).alias("paragraph", "line"))
        .filter(anchored(F.col("line")))
    )
    words = F.regexp_extract_all(F.lower("line"), F.lit(_WORD), F.lit(0))
    pairs = F.zip_with("words", F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    grams = F.array_distinct(F.concat("words", F.filter(pairs, lambda g: g.isNotNull())))
    # A map is searched entry by entry, so only n-grams that hash sets have met are looked up in it:
    # the anchors of the line give the n-grams with weights that it may hold, and those meet its own.
    by_anchor = F.map_from_arrays(anchors, _literal([[g for g in model.grams if a in g.split()] for a in model.anchors], "array<array<string>>"))
    possible = F.flatten(F.transform(F.array_intersect("words", anchors), lambda a: F.try_element_at(by_anchor, a)))
    met = F.array_intersect("grams", "possible")
    found = F.transform("met", lambda g: F.try_element_at(table, g))
    scaled = F.transform(F.slice("total", 1, classes), lambda z: z / F.lit(model.temperature))
    exps = F.transform("scaled", lambda z: F.exp(z - F.array_max("scaled")))
    names = _literal([*model.families, UNKNOWN], "array<string>")
    owners = _literal([f for f, _ in NOTICES], "array<string>")
    shares = F.transform(F.slice("total", classes + 1, notices), lambda s, n: F.when(F.get(owners, n) == F.col("family"), s))

    def computed(df: DataFrame, *columns: Column) -> DataFrame:
        """Columns as a generator gives them: the optimizer does not copy what they are made of into filters above."""
        names = [f"c{n}" for n in range(len(columns))]
        return df.select("doc_id", "paragraph", F.stack(F.lit(1), *columns).alias(*names))

    def named(df: DataFrame, *names: str) -> DataFrame:
        return df.toDF("doc_id", "paragraph", *names)

    worded = named(computed(lines, words), "words")
    paired = named(computed(worded, grams, possible), "grams", "possible")
    meeting = named(computed(paired, met), "met").filter(F.size("met") > 0)
    summed = named(computed(meeting, F.aggregate(found, start, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))), "total")
    raised = named(computed(summed, F.col("total"), scaled), "total", "scaled")
    likely = named(computed(raised, F.col("total"), exps), "total", "exps")
    probability = F.array_max("exps") / F.aggregate("exps", F.lit(0.0), lambda a, e: a + e)
    family = F.get(names, F.array_position("exps", F.array_max("exps")).cast("int") - 1)
    judged = named(computed(likely, F.col("total"), probability, family), "total", "probability", "family")
    judged = judged.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))
    similarity = F.array_max(shares)
    return judged.select("doc_id", "paragraph", "family", "probability", similarity.alias("similarity")).withColumn("confirmed", F.col("similarity") >= CONFIRMED)

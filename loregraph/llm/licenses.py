"""Licence scans with a trained paragraph classifier.

Paragraphs end at empty lines. Their wrapped lines are joined and cut into sentences; lines of a sentence
count alone where they say something else, and sentences that say nothing alone are judged together. A
multinomial logistic regression over hashed word n-grams (one to three words), trained here on the
templates below, their variations and paragraphs that are no licence, gives a family and a probability;
its temperature and the probability below which a paragraph is of unknown family are set on variations
that weren't trained on. A prediction stands if the paragraph also shares enough word pairs with a
template of that family.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names and customary sentences of each family's notices.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "CC0": ["Dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
}
# What follows the opening of a short notice, by family.
NAMES = {
    "MIT": ["the MIT License", "MIT", "the MIT licence"], "Apache-2.0": ["the Apache License, Version 2.0", "Apache-2.0", "the Apache 2.0 license"],
    "GPL": ["the GNU General Public License, version 3", "the GNU GPL v2", "GPL-3.0", "GPL-2.0-or-later"], "LGPL": ["the GNU Lesser General Public License, version 3", "LGPL-2.1", "the LGPL"],
    "AGPL": ["the GNU Affero General Public License, version 3", "AGPL-3.0", "the AGPL"], "BSD": ["the BSD License", "the 2-Clause BSD License", "BSD-3-Clause", "BSD-2-Clause"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "MPL-2.0", "the MPL 2.0"], "ISC": ["the ISC License", "ISC"], "Unlicense": ["the Unlicense"],
    "CC0": ["CC0 1.0", "CC0-1.0", "Creative Commons Zero"], "CC-BY": ["CC BY 4.0", "CC-BY-4.0", "a Creative Commons Attribution 4.0 license"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC-BY-SA-3.0", "a Creative Commons Attribution-ShareAlike license"], "CC-BY-NC": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "a Creative Commons Attribution-NonCommercial license"],
    "CC-BY-ND": ["CC BY-ND 4.0", "CC-BY-ND-4.0", "a Creative Commons Attribution-NoDerivatives license"],
}
OPENINGS = ["Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "Distributed under the terms of {}.", "This project is available under {}.", "SPDX-License-Identifier: {}", "License: {}", "The code is licensed under {}."]
# Paragraphs that use the words of licences and are none.
OTHERS = [
    "Please renew your driver's license before it expires.", "The car's license plate was stolen.", "A fishing license is required in this state.", "Copyright 2019 by the author. All rights reserved.",
    "No part of this publication may be reproduced without the prior written permission of the publisher.", "She asked for permission to leave the room.", "The warranty covers parts and labour for two years.",
    "Students at MIT released a study on public transport.", "The Apache helicopter landed near the village.", "General Public Works announced a new version of the plan.", "Our license terms have changed, contact sales.",
    "The bar lost its liquor license.", "Creative people in common rooms work better.", "The software is licensed, not sold.", "This license agreement is between you and the company.", "Without permission no one may copy, modify or sell this report.",
    "The court ruled on the licensing of public broadcasts.", "It is free and open to the public.", "The terms under which the work was published are unknown.", "An attribution of the painting to the master was denied.",
]

#: Buckets of hashed n-grams, and the share of a paragraph's word pairs that a template must hold.
DIMS, CONFIRM = 1 << 14, 0.5
#: Share of held-out paragraphs without licence that may pass as one.
FALSE_ACCEPT = 0.005
UNKNOWN = "unknown"

#: What isn't confirmed is listed as of unknown family if it has one of these; the classifier sees all the same.
_ANCHOR = re.compile(r"(?i)licen[sc]e|\bspdx\b|\b[al]?gpl\b|under the terms of|released under|available under|\bbsd-|\bapache-2|\bmpl-|\bcc0\b|\bcc[ -]by\b|public domain|creative commons|hereby granted|redistribution and use|free software|copyright notice|copyright holder|waived all copyright|mozilla public|warranties or conditions")
#: Each alternative of the anchor has one of these; the characters are those that match letters in other ways.
_SIGNS = ("licen", "spdx", "gpl", "under the terms of", "released under", "available under", "bsd-", "apache-2", "mpl-", "cc0", "cc by", "cc-by", "public domain", "creative commons", "hereby granted", "redistribution and use", "free software", "copyright notice", "copyright holder", "waived all copyright", "mozilla public", "warranties or conditions")
_FOLDED = re.compile("[\u0130\u0131\u017f\u212a]")
_PIECE = re.compile(r"[^\n]+?(?:[.!?](?=\s)|(?=\n)|\Z)", re.S)
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _grams(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def _features(words: list[str]) -> np.ndarray:
    return np.unique(np.array([zlib.crc32(g.encode()) % DIMS for g in _grams(words)], np.int64))


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False)) or {(w, "") for w in words}


@dataclass
class Classifier:
    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    known: np.ndarray
    temperature: float = 1.0
    accept: float = 0.5

    def logits(self, words: list[str]) -> np.ndarray:
        ids = _features(words)
        ids = ids[self.known[ids]]  # n-grams that training never saw have no weight
        return self.bias + self.weights[ids].sum(axis=0) / np.sqrt(max(1, len(ids)))

    def predict(self, words: list[str]) -> tuple[str, float]:
        z = self.logits(words) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return (self.families[k] if p[k] >= self.accept else UNKNOWN), float(p[k])


def _variations(seed: int, rounds: int) -> list[tuple[str, list[str]]]:
    """(family, words): templates and short notices, some with words left out, in other words or cut."""
    rng = np.random.default_rng(seed)
    bases = [(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(f, o.format(n)) for f, ns in NAMES.items() for n in ns for o in OPENINGS]
    vocabulary = sorted({w for _, t in bases for w in _words(t)} | {w for t in OTHERS for w in _words(t)})
    noise = lambda n: [str(w) if rng.random() < 0.5 else "".join(rng.choice(list("abcdefghilmnorstu"), rng.integers(2, 9))) for w in rng.choice(vocabulary, n)]
    out = []
    for _ in range(rounds):
        for family, text in bases:
            words = _words(text)
            if len(words) > 12 and rng.random() < 0.5:
                cut = int(rng.integers(0, len(words) // 3))
                words = words[cut : cut + max(10, int(len(words) * 0.7))]
            if rng.random() < 0.3:
                words = [w for w in words if rng.random() > 0.05]
            if rng.random() < 0.3:
                words = noise(int(rng.integers(1, 4))) + words
            out.append((family, words))
        for text in OTHERS * 3:
            out.append((UNKNOWN, [w for w in _words(text) if rng.random() > 0.1] + noise(int(rng.integers(0, 4)))))
        for _ in range(len(bases)):
            out.append((UNKNOWN, noise(int(rng.integers(3, 25)))))
    return [(f, w) for f, w in out if w]


@lru_cache(maxsize=1)
def classifier() -> Classifier:
    """Train; the same result each time, a few seconds of one core."""
    families = [*TEMPLATES, UNKNOWN]
    index = {f: i for i, f in enumerate(families)}
    data = _variations(1, 3)
    feats = [_features(w) for _, w in data]
    rows, cols = np.repeat(np.arange(len(data)), [len(x) for x in feats]), np.concatenate(feats)
    scale = 1 / np.sqrt([max(1, len(x)) for x in feats])
    used, col = np.unique(cols, return_inverse=True)
    y = np.eye(len(families))[[index[f] for f, _ in data]]
    w, b = np.zeros((len(used), len(families))), np.zeros(len(families))
    m1, m2, c1, c2 = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    order = np.argsort(rows, kind="stable")
    starts = np.cumsum([0] + [len(x) for x in feats[:-1]])
    by_col = np.argsort(col, kind="stable")
    col_starts = np.searchsorted(col[by_col], np.arange(len(used)))
    for t in range(1, 121):
        z = np.add.reduceat(w[col[order]], starts, axis=0) * scale[:, None] + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        r = (p / p.sum(axis=1, keepdims=True) - y) / len(data)
        g = np.add.reduceat((r * scale[:, None])[rows[by_col]], col_starts, axis=0) + 1e-6 * w
        gb = r.sum(axis=0)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        c1, c2 = 0.9 * c1 + 0.1 * gb, 0.999 * c2 + 0.001 * gb * gb
        fix1, fix2 = 1 - 0.9**t, 1 - 0.999**t
        w -= 0.2 * (m1 / fix1) / (np.sqrt(m2 / fix2) + 1e-8)
        b -= 0.2 * (c1 / fix1) / (np.sqrt(c2 / fix2) + 1e-8)
    weights, known = np.zeros((DIMS, len(families))), np.zeros(DIMS, bool)
    weights[used], known[used] = w, True
    model = Classifier(families, weights, b, known)
    held = _variations(2, 1)
    z = np.stack([model.logits(x) for _, x in held])
    truth = np.array([index[f] for f, _ in held])

    def probabilities(temperature: float) -> np.ndarray:
        q = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return q / q.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.25, 8, 41)
    model.temperature = float(min(grid, key=lambda t: -np.log(probabilities(t)[np.arange(len(truth)), truth] + 1e-12).mean()))
    none = probabilities(model.temperature)[truth == index[UNKNOWN]][:, : len(TEMPLATES)].max(axis=1)
    model.accept = float(max(0.5, np.quantile(none, 1 - FALSE_ACCEPT)))
    return model


def _templates() -> dict[str, list[set[tuple[str, str]]]]:
    texts = {f: ts + [o.format(n) for n in NAMES.get(f, []) for o in OPENINGS] for f, ts in TEMPLATES.items()}
    return {f: [_pairs(_words(t)) for t in ts] for f, ts in texts.items()}


def pairs_of(templates: dict[str, list[set[tuple[str, str]]]]) -> dict[tuple[str, str], list[tuple[int, int]]]:
    """Number and size of the templates with each word pair."""
    out: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for i, t in enumerate(t for ts in templates.values() for t in ts):
        for pair in t:
            out.setdefault(pair, []).append((i, len(t)))
    return out


def _confirmable(words: list[str], known: dict[tuple[str, str], list[tuple[int, int]]]) -> bool:
    """Whether any template, of whatever family, holds enough of the word pairs."""
    if known.keys().isdisjoint(zip(words, words[1:], strict=False)):
        return False
    pairs = set(zip(words, words[1:], strict=False))
    held = Counter(t for p in pairs & known.keys() for t in known[p])
    return any(n / min(len(pairs), size) >= CONFIRM for (_, size), n in held.items())


def _talks(text: str) -> bool:
    """Whether ``text`` has an anchor; where lower case tells, plain searches rule it out first."""
    if not _FOLDED.search(text):
        low = text.lower()
        if not any(x in low for x in _SIGNS):
            return False
    return _ANCHOR.search(text) is not None


@dataclass
class _Unit:
    start: int
    end: int
    words: list[str]
    family: str = UNKNOWN
    p: float = 0.0
    similar: float = 0.0

    @property
    def sure(self) -> bool:
        return self.family != UNKNOWN


def _similar(words: list[str], templates: list[set]) -> float:
    pairs = _pairs(words)
    return max((len(pairs & t) / min(len(pairs), len(t)) for t in templates), default=0.0)


def _judge(start: int, end: int, words: list[str], model: Classifier, templates: dict, known: dict) -> _Unit:
    """Where no template would confirm any family, the classifier's word changes nothing."""
    unit = _Unit(start, end, words)
    if _confirmable(words, known):
        family, unit.p = model.predict(words)
        if family != UNKNOWN:
            unit.similar = _similar(words, templates[family])
            unit.family = family if unit.similar >= CONFIRM else UNKNOWN
    return unit


def _sentence(lines: list[_Unit], judge, templates: dict) -> list[_Unit]:
    """A sentence of several lines as one, but for lines that are notices of other families."""
    if len(lines) == 1:
        return lines
    whole = judge(lines)
    stand = [x.sure and (not whole.sure or x.family != whole.family and x.similar > _similar(x.words, templates[whole.family])) for x in lines]
    if not any(stand):
        return [whole] if whole.sure else lines
    out: list[_Unit] = []
    for alone, run in groupby(zip(stand, lines, strict=True), key=lambda x: x[0]):
        part = [x for _, x in run]
        out += part if alone else _sentence(part, judge, templates)
    return out


def scan_text(text: str | None, model: Classifier, templates: dict, known: dict | None = None) -> list[tuple[str, int, int, float, float]]:
    """(family, start, end, probability, similarity) of each licence paragraph; code points, end exclusive."""
    if not text:
        return []
    known = pairs_of(templates) if known is None else known

    def judge(parts: list[_Unit]) -> _Unit:
        return _judge(parts[0].start, parts[-1].end, [w for x in parts for w in x.words], model, templates, known)

    paragraphs: list[list[list[_Unit]]] = []  # paragraphs of sentences of lines
    at, ended = -1, True
    for m in _PIECE.finditer(text):
        piece = m[0]
        start = m.start() + len(piece) - len(piece.lstrip())
        if start == m.end():
            continue
        if at < 0 or text.count("\n", at, start) > 1:
            paragraphs.append([])
            ended = True
        if ended:
            paragraphs[-1].append([])
        paragraphs[-1][-1].append(_judge(start, m.end(), _words(piece), model, templates, known))
        at, ended = m.end(), piece[-1] in ".!?"
    talks = _talks(text)
    found: list[tuple[str, int, int, float, float]] = []
    for paragraph in paragraphs:
        units = [x for lines in paragraph for x in _sentence(lines, judge, templates)]
        for sure, run in groupby(units, key=lambda x: x.sure):
            part = list(run)
            if not sure and len(part) > 1 and (whole := judge(part)).sure:
                part = [whole]
            for x in part:
                if not x.sure and not (talks and _ANCHOR.search(text[x.start : x.end])):
                    continue
                if not x.sure and not x.p:
                    x.p = model.predict(x.words)[1]
                family, start, p, similar = x.family, x.start, x.p, x.similar
                if found and found[-1][0] == family and not text[found[-1][2] : start].strip():
                    last = found.pop()
                    start, p, similar = last[1], max(p, last[3]), max(similar, last[4])
                found.append((family, start, x.end, p, similar))
    return found


SPANS = "array<struct<family:string,start:int,end:int,probability:double,similarity:double>>"


def scan(docs: DataFrame, text: str = "text", into: str = "licenses") -> DataFrame:
    """``docs`` with the licence paragraphs of ``text`` in ``into``; null and empty texts have none. A
    column that is named ``into`` is replaced, all others stay. An empty table gives an empty result."""
    sent = docs.sparkSession.sparkContext.broadcast((classifier(), _templates()))  # of fixed size

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, templates = sent.value
        known = pairs_of(templates)
        for s in batches:
            yield pd.Series([[dict(zip(("family", "start", "end", "probability", "similarity"), x, strict=True)) for x in scan_text(t, model, templates, known)] for t in s], dtype=object)

    return docs.withColumn(into, F.pandas_udf(run, SPANS)(F.col(text)))


def license_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_paragraphs, n_confirmed, families (distinct,
    sorted, comma-joined, without unknown), spans (family:start:end, comma-joined, unknown included).

    Null and empty texts have none. Null doc_id and repeated rows are reported like others. An empty table
    gives an empty result.
    """
    scanned = scan(docs.select("doc_id", "text")).select("doc_id", "licenses")
    sure = F.filter("licenses", lambda x: x["family"] != UNKNOWN)
    return scanned.select(
        "doc_id", F.size("licenses").cast("long").alias("n_paragraphs"), F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["family"], x["start"].cast("string"), x["end"].cast("string"))), ",").alias("spans"),
    )

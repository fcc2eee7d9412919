"""Licence scans by a trained paragraph classifier.

Each paragraph, a line or a window of a long line, is classified by logistic regression over hashed
word n-grams: a licence family or none. It is trained on variations of the templates below and on
ordinary paragraphs of the corpus. A likely licence with no clear family, or whose wording does not
agree with a template of its family, is ``unknown``; the limit for clear is calibrated on variations
kept back from training.

Null and empty texts have no paragraphs and no licences. Rows, repeated or not, get one result each.
Without ordinary paragraphs the classifier is trained on the templates' own words in disorder.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.hashing import LOWER, as_bytes, mix64, span_hashes
from windrow.llm.sampling import excerpt

# Usual wordings of public licences and their notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
# Licence talk that names no family of TEMPLATES.
OTHER_WORDINGS = [
    "Licensed under the terms of the Acme Public License, version 7.",
    "This work is licensed under the Example Community License.",
    "All rights reserved. No part of this work may be reproduced without permission.",
    "Use of this software is governed by the licence agreement that came with it.",
    "Released under the terms of the Foo Source License.",
]
NONE, UNKNOWN = "none", "unknown"
FAMILIES = sorted(TEMPLATES)
BUCKETS = 1 << 14
# Lines up to LONGEST words are looked at whole, those over WINDOW words by windows too.
LONGEST, WINDOW, STRIDE = 120, 16, 8
ORDINARY_ROWS = 1_000
LEAST_AGREEMENT = 0.6

_BREAKS = np.ones(256, bool)
_BREAKS[48:58] = _BREAKS[97:123] = _BREAKS[128:] = False


def paragraphs(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the text, first and last word of each paragraph, and the words' byte starts."""
    data = LOWER[as_bytes(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (~_BREAKS[data]).astype(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    hashes = span_hashes(data, starts, ends)
    lines = np.searchsorted(np.flatnonzero(data == 10), starts)
    cut = np.flatnonzero(np.diff(lines)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(hashes)]])
    if not len(hashes):
        return hashes, first[:0], last[:0], starts
    long = last - first > WINDOW
    if long.any():
        pairs = [(a, b) for a, b in zip(first[~long], last[~long])]
        for a, b in zip(first[long], last[long]):
            if b - a <= LONGEST:
                pairs.append((a, b))
            pairs += [(i, min(i + WINDOW, b)) for i in range(a, max(a + 1, b - STRIDE), STRIDE)]
        first, last = np.array(sorted(pairs)).T
    return hashes, first, last, starts


def _features(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs that begin at each word but the last."""
    pairs = mix64(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) > 1 else hashes[:0]
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), (pairs % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class LicenceModel:
    classes: list[str]
    weights: np.ndarray
    bias: np.ndarray
    limit: float

    def probabilities(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Paragraphs by classes. Sums over words and pairs come from running totals."""
        if not len(first):
            return np.zeros((0, len(self.classes)))
        words, pairs = _features(hashes)
        totals = [np.vstack([np.zeros((1, len(self.classes))), np.cumsum(self.weights[x], axis=0, dtype=np.float64)]) for x in (words, pairs)]
        z = totals[0][last] - totals[0][first] + totals[1][np.maximum(last - 1, first)] - totals[1][first]
        z = z / np.sqrt(np.maximum(2 * (last - first) - 1, 1))[:, None] + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _variations(wording: str, chance: random.Random) -> str:
    words = wording.split()
    if len(words) > 8 and chance.random() < 0.4:
        at = chance.randrange(len(words) - 6)
        words = words[at : at + max(6, chance.randint(6, len(words)))]
    words = [w for w in words if chance.random() > 0.04]
    return chance.choice([str, str.upper, str.lower, str])(" ".join(words))


def fit(ordinary: Iterable[str], seed: int = 3, each: int = 80, epochs: int = 12) -> LicenceModel:
    chance, rows = random.Random(seed), []
    for family in FAMILIES:
        rows += [(_variations(w, chance), family) for w in TEMPLATES[family] for _ in range(each // len(TEMPLATES[family]) + 8)]
    rows += [(_variations(w, chance), UNKNOWN) for w in OTHER_WORDINGS for _ in range(16)]
    plain = [p for p in ordinary if p and "licen" not in p.lower()]
    vocabulary = [w for t in TEMPLATES.values() for x in t for w in x.split()]
    plain += [" ".join(chance.choice(vocabulary) for _ in range(chance.randint(3, 20))) for _ in range(150)]
    rows += [(p, NONE) for p in plain]
    chance.shuffle(rows)
    classes = [*FAMILIES, NONE, UNKNOWN]
    data = []
    for text, name in rows:
        hashes = paragraphs(text.replace("\n", " "))[0][:LONGEST]
        if len(hashes):
            words, pairs = _features(hashes)
            data.append((np.concatenate([words, pairs]), 1 / np.sqrt(2 * len(hashes) - 1), classes.index(name)))
    weights, bias = np.zeros((BUCKETS, len(classes))), np.zeros(len(classes))
    for epoch in range(epochs):
        for i, (x, scale, y) in enumerate(data):
            if i % 5 == 0:
                continue
            z = weights[x].sum(axis=0) * scale + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            step = 0.5 * (1 - epoch / epochs)
            np.subtract.at(weights, x, step * scale * p)
            bias -= step * 0.1 * p
    model = LicenceModel(classes, weights.astype(np.float32), bias, 0.5)
    right = []
    for x, scale, y in data[::5]:
        z = weights[x].sum(axis=0) * scale + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        if p.argmax() == y and classes[y] in TEMPLATES:
            right.append(p[y])
    model.limit = float(np.quantile(right, 0.02)) if right else 0.5
    return model


def _triples(text: str) -> set[tuple[str, ...]]:
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}


def agreement(paragraph: str, family: str) -> float:
    """The largest share of a template's word triples that the paragraph has, or the other way
    round for a piece of a long template."""
    own = _triples(paragraph)
    shares = []
    for wording in TEMPLATES[family]:
        other = _triples(wording)
        both = len(own & other)
        shares += [both / len(other), both / len(own) if len(own) >= 4 else 0.0]
    return max(shares)


def find(model: LicenceModel, text: str | None) -> list[tuple[str, int, int]]:
    """``family, start, end`` (bytes of the UTF-8 text) of each licence paragraph."""
    hashes, first, last, starts = paragraphs(text)
    p = model.probabilities(hashes, first, last)
    out = []
    none = model.classes.index(NONE)
    data = (text or "").encode("utf-8", "surrogatepass")
    for i in np.flatnonzero(p.argmax(axis=1) != none) if len(p) else []:
        end = int(starts[last[i]]) if last[i] < len(starts) else len(data)
        piece = data[starts[first[i]] : end].decode("utf-8", "replace")
        named = int(p[i, : len(FAMILIES)].argmax())
        clear = p[i, named] >= model.limit and agreement(piece, FAMILIES[named]) >= LEAST_AGREEMENT
        if clear or p[i, none] < 0.01:
            out.append((FAMILIES[named] if clear else UNKNOWN, int(starts[first[i]]), end))
    return _merged(out)


def _merged(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Of overlapping finds the longest named one stays; neighbours of one family become one."""
    kept: list[tuple[str, int, int]] = []
    for family, start, end in sorted(found, key=lambda x: (x[0] == UNKNOWN, x[1] - x[2], x[1])):
        if all(end <= a or b <= start for _, a, b in kept):
            kept.append((family, start, end))
    out: list[tuple[str, int, int]] = []
    for family, start, end in sorted(kept, key=lambda x: x[1]):
        if out and out[-1][0] == family and out[-1][2] == start:
            start = out.pop()[1]
        out.append((family, start, end))
    return out


def ordinary_paragraphs(docs: DataFrame, rows: int = ORDINARY_ROWS) -> list[str]:
    """Lines of excerpts of the ``rows`` different texts with the least hashes, on the driver.

    Texts far from the least hashes are left out before the sort, by the number of different texts, so
    that what reaches the driver does not grow with the table.
    """
    hashed = docs.where("text is not null").select(F.xxhash64("text").alias("h"), "text")
    n = hashed.agg(F.approx_count_distinct("h")).first()[0]
    near = hashed.where((F.col("h") / float(1 << 64) + 0.5) * n < 2 * rows)
    chosen = near.groupBy("h").agg(F.min(excerpt(F.col("text"), 400)).alias("t"))
    return [line for r in chosen.orderBy("h").limit(rows).collect() for line in r["t"].split("\n")]


def scan(docs: DataFrame, model: LicenceModel, text_col: str = "text", out_col: str = "licences") -> DataFrame:
    """``docs`` with ``out_col array<struct<family, start, end>>`` over the whole text; a column of that
    name is replaced."""

    @F.arrow_udf("array<struct<family:string,start:int,end:int>>")
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("family", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for texts in batches:
            found = [find(model, t.as_py()) for t in texts]
            yield pa.array([[{"family": f, "start": a, "end": b} for f, a, b in x] for x in found], kind)

    return docs.withColumn(out_col, scanned(F.col(text_col)))

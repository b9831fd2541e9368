"""Licence scan: a trained paragraph classifier confirmed by templates.

Paragraphs are lines; of lines over LONG words every window of LONG words,
half a window apart, is one.  Of lines over two SHORT windows every window of
SHORT words, STEP words apart, is one too, so that prose around a short notice
does not outvote it.  Sparse counts of word 1-, 2- and 3-grams, hashed
and scaled by the root of the paragraph's length, go into a multinomial
logistic regression over licence families and ``none``, trained with Spark ML
on random excerpts of the templates below, alone and inside prose of the
corpus, and on paragraphs of the corpus.

The training sample is bounded: VARIANTS excerpts a template and at most about
NEGATIVES paragraphs, taken by hash.  On the held-out half of it two bars are
calibrated: the probability of a licence that all but QUIET of the corpus
paragraphs stay below, and the family probability that KEEP of the excerpts
reach.  A paragraph above the first bar is a candidate; it gets its family if
it is above the second one and shares enough word pairs with a template of
that family; else it is ``unknown`` if it shares some with any template, and
no licence otherwise.  Scoring reads every paragraph of every text.

SPDX tags (``SPDX-License-Identifier:`` and an expression) need no model: their
identifiers are read exactly, those of no family here as ``unknown``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm import arrays as A
from tidewatch.llm.repeats import _arrow

BUCKETS = 1 << 14
LONG = 48
#: words of a short window of a long line, and words between two of them
SHORT, STEP = 12, 4
VARIANTS, NEGATIVES = 40, 6000
QUIET, KEEP = 0.001, 0.98
#: share of a template excerpt's word pairs, or of the paragraph's, that confirms
CONFIRM = 0.6
#: the share that lets a paragraph count as an unknown licence
HINT = 0.15
NONE, UNKNOWN = "none", "unknown"

# Sentences by which licences are granted, by family.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "This project is distributed under the terms of the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License, version 2.", "Licensed under the GPL v3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL v3.",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "BSD": ["Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "Licensed under the 2-clause BSD license.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Released under CC BY 3.0."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC-SA 4.0."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0 Universal.", "Dedicated to the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "Proprietary": ["All rights reserved.", "Copyright (c) the authors. All rights reserved. No part of this publication may be reproduced without permission."],
}
# Paragraphs of the licences' bodies and notices, by family.
BODIES = {
    "MIT": ["including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "Apache-2.0": ["See the License for the specific language governing permissions and limitations under the License.",
                   "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
                   "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work",
                   "You must give any other recipients of the Work or Derivative Works a copy of this License; and You must cause any modified files to carry prominent notices stating that You changed the files"],
    "GPL": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
            "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
            "The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
             "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation"],
    "AGPL": ["You should have received a copy of the GNU Affero General Public License along with this program.",
             "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."],
    "BSD": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
            "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY"],
    "MPL-2.0": ["This Source Code Form is \"Incompatible With Secondary Licenses\", as defined by the Mozilla Public License, v. 2.0.",
                "Covered Software is provided under this License on an \"as is\" basis, without warranty of any kind, either expressed, implied, or statutory, including, without limitation, warranties that the Covered Software is free of defects, merchantable, fit for a particular purpose or non-infringing."],
    "ISC": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
            "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "CC0": ["You can copy, modify, distribute and perform the work, even for commercial purposes, all without asking permission."],
    "Unlicense": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
                  "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."],
}
TEMPLATES = {f: texts + BODIES.get(f, []) for f, texts in TEMPLATES.items()}
FAMILIES = sorted(TEMPLATES)

# SPDX identifiers (lower case) by family.
SPDX = {
    "MIT": r"mit", "Apache-2.0": r"apache-2\.0", "GPL": r"gpl-[123]\.0(-only|-or-later)?", "LGPL": r"lgpl-(2\.0|2\.1|3\.0)(-only|-or-later)?",
    "AGPL": r"agpl-[13]\.0(-only|-or-later)?", "BSD": r"bsd-[1234]-clause", "MPL-2.0": r"mpl-2\.0(-no-copyleft-exception)?", "ISC": r"isc",
    "CC-BY": r"cc-by-[0-9.]+", "CC-BY-SA": r"cc-by-sa-[0-9.]+", "CC-BY-NC": r"cc-by-nc(-sa|-nd)?-[0-9.]+", "CC0": r"cc0-1\.0", "Unlicense": r"unlicense",
}
SPDX_TAG = b"spdx-license-identifier:"
SPDX_TERM = rb"\(*[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?\)*"
SPDX_EXPRESSION = re.compile(SPDX_TAG + rb"[ \t]*(" + SPDX_TERM + rb"(?:[ \t]+(?:and|or|with)[ \t]+" + SPDX_TERM + rb")*)")
#: values that state no licence
SPDX_NOTHING = {"none", "noassertion"}


class Paragraphs:
    """Paragraphs of a block of texts: word spans and hashed n-grams."""

    def __init__(self, column):
        data, offs = A.utf8(column)
        self.words = w = A.Words(data, offs, lower=True, gap=A.NOT_ALNUM)
        h = w.hashes(51)
        # line of each word: by the line feeds before it, and the text
        breaks = np.cumsum(data == 10)
        line = breaks[w.start] if len(w) else np.zeros(0, np.int64)
        new = np.ones(len(w), bool)
        new[1:] = (np.diff(line) != 0) | (np.diff(w.text) != 0)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(w)))
        end = first + size
        long_ = np.where(size > LONG, -(-(size - LONG) // (LONG // 2)) + 1, 1)
        short = np.where(size > 2 * SHORT, -(-(size - SHORT) // STEP) + 1, 0)
        n = long_ + short                            # a line's long windows, then its short ones
        own = np.repeat(np.arange(len(first)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        small = step >= long_[own]
        self.start = first[own] + np.where(small, (step - long_[own]) * STEP, step * (LONG // 2))
        self.end = np.minimum(self.start + np.where(small, SHORT, LONG), end[own])
        self.text = w.text[self.start] if len(first) else np.zeros(0, np.int64)
        self.grams = [(A.windows(h, k, 60 + k) & np.uint64(BUCKETS - 1)).astype(np.int64) for k in (1, 2, 3)]

    def counts(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and scaled counts of one paragraph."""
        a, b = self.start[i], self.end[i]
        every = np.concatenate([g[a:max(a, b - k)] for k, g in enumerate(self.grams)])
        at, n = np.unique(every, return_counts=True)
        return at, n / np.sqrt(b - a)

    def logits(self, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Scores of every paragraph: sums of the weights of its n-grams."""
        out = np.zeros((len(self.start), len(bias)))
        step = 50_000                                # paragraphs at once
        for a in range(0, len(out), step):
            s, e = self.start[a:a + step], self.end[a:a + step]
            lo, hi = s.min(), e.max()
            for k, g in enumerate(self.grams):
                part = weights[g[lo:max(lo, hi - k)]]
                cum = np.zeros((hi - lo + 1, len(bias)))
                np.cumsum(part, axis=0, out=cum[1:len(part) + 1])
                cum[len(part) + 1:] = cum[len(part)]
                out[a:a + step] += cum[np.maximum(e - k, s) - lo] - cum[s - lo]
            out[a:a + step] /= np.sqrt(e - s)[:, None]
        return out + bias

    def tokens(self, i: int) -> list[bytes]:
        w = self.words
        return [w.data[w.start[j]:w.end[j]].tobytes() for j in range(self.start[i], self.end[i])]


def _pairs(tokens: list) -> set:
    return set(zip(tokens, tokens[1:])) or {(t,) for t in tokens}


_PAIRS: dict[str, list[set]] = {}


def similarity(tokens: list[bytes], family: str) -> float:
    """Best overlap of word pairs with a template of the family, as a share
    of the smaller side (of at least a quarter of the template)."""
    if not _PAIRS:
        for f, texts in TEMPLATES.items():
            p = Paragraphs(pa.array([t.replace("\n", " ") for t in texts]))
            own: list[list] = [[] for _ in texts]
            for i, t in enumerate(p.text):
                own[t] = own[t] + p.tokens(i)
            _PAIRS[f] = [_pairs(x) for x in own]
    own = _pairs(tokens)
    return max(len(own & t) / max(min(len(own), len(t)), len(t) / 4, 1) for t in _PAIRS[family])


@dataclass
class Model:
    classes: list[str]
    weights: np.ndarray
    bias: np.ndarray
    candidate: float        # probability of any licence
    sure: float             # probability of the family

    def probabilities(self, p: Paragraphs) -> np.ndarray:
        z = p.logits(self.weights, self.bias)
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        return z / z.sum(axis=1, keepdims=True) if len(z) else z


def _excerpts(rng: np.random.Generator) -> list[tuple[str, int]]:
    """Random excerpts of every template, with a few words lost or added."""
    out = []
    for i, f in enumerate(FAMILIES):
        for text in TEMPLATES[f]:
            words = text.split()
            for v in range(VARIANTS):
                keep = [w for w in words if rng.random() > 0.05 * (v > 0)] or words
                if len(keep) > 12 and v % 2:
                    at = rng.integers(0, len(keep) - 10)
                    keep = keep[at:at + int(rng.integers(10, len(keep) - at + 1))]
                if v % 3 == 2:
                    keep = ["Copyright", str(rng.integers(1990, 2030)), f"holder{rng.integers(1e6)}"] + keep
                out.append((" ".join(keep), i))
    return out


def _embedded(excerpts: list[tuple[str, int]], prose: list[str], rng: np.random.Generator) -> list[tuple[str, int]]:
    """Short windows that hold an excerpt, or SHORT - STEP words of it at
    least, and words of the corpus around it."""
    out = []
    for text, y in excerpts[::2]:
        words, around = text.split(), prose[rng.integers(len(prose))].split() or ["a"]
        if len(words) > SHORT - STEP:
            at = rng.integers(0, len(words) - (SHORT - STEP) + 1)
            words = words[at:at + int(rng.integers(SHORT - STEP, SHORT + 1))]
        gap = max(SHORT - len(words), 0)
        at, before = rng.integers(len(around)), int(rng.integers(0, gap + 1))
        fill = [around[(at + i) % len(around)] for i in range(gap)]
        out.append((" ".join(fill[:before] + words + fill[before:]), y))
    return out


def _split(batches):
    """Lines to their paragraphs, as words joined by one space."""
    for batch in batches:
        for a, b in A.slices(batch.column(0)):
            p = Paragraphs(batch.column(0).slice(a, b - a))
            texts = [b" ".join(p.tokens(i)).decode("utf-8", "replace") for i in range(len(p.start))]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["line"])


def train(docs: DataFrame, text: str = "text", seed: int = 0) -> Model:
    """The classifier and its bars.  Corpus paragraphs that a template confirms
    are left out of the negatives; an empty corpus leaves the excerpts' own
    words as the only evidence."""
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split(F.col(text).cast("string"), "\n")).alias("line")).where("trim(line) <> ''") \
        .withColumn("h", F.xxhash64("line"))
    total = lines.count()
    cut = int(min(1.0, NEGATIVES / max(total, 1)) * (1 << 30))
    some = lines.where(F.pmod("h", F.lit(1 << 30)) <= cut).select("line").distinct() \
        .mapInArrow(_split, "line string").distinct().orderBy(F.xxhash64("line", F.lit(1)), "line").limit(2 * NEGATIVES)
    negatives = [r["line"] for r in some.collect()
                 if max(similarity(r["line"].encode().split(), f) for f in FAMILIES) < CONFIRM]
    if not negatives:
        negatives = ["lorem ipsum dolor sit amet", "no terms are stated here"]
    alone = _excerpts(np.random.default_rng(seed))
    rows = alone + _embedded(alone, negatives, np.random.default_rng(seed + 2)) + [(t, len(FAMILIES)) for t in negatives]
    feats = []
    for t, y in rows:
        p = Paragraphs(pa.array([t.replace("\n", " ")]))
        # of a corpus line only itself: its windows are among the sampled paragraphs
        feats += [(float(y), p.counts(i)) for i in range(len(p.start) if y < len(FAMILIES) else min(len(p.start), 1))]
    half = np.random.default_rng(seed + 1).random(len(feats)) < 0.5
    frame = spark.createDataFrame([(y, Vectors.sparse(BUCKETS, at.tolist(), n.tolist()))
                                   for (y, (at, n)), h in zip(feats, half) if h], ["label", "features"])
    fit = LogisticRegression(family="multinomial", maxIter=25, regParam=1e-4, standardization=False).fit(frame.coalesce(2))
    weights = np.zeros((BUCKETS, len(FAMILIES) + 1))
    bias = np.full(len(FAMILIES) + 1, -30.0)
    coef = fit.coefficientMatrix.toArray()
    weights[:, :coef.shape[0]], bias[:coef.shape[0]] = coef.T, fit.interceptVector.toArray()
    model = Model([*FAMILIES, NONE], weights.astype(np.float32), bias, 0.5, 0.5)

    def probability(at, n):
        z = n @ weights[at] + bias
        z = np.exp(z - z.max())
        return z / z.sum()

    held = [(int(y), probability(*x)) for (y, x), h in zip(feats, half) if not h]
    quiet = sorted(1 - p[-1] for y, p in held if y == len(FAMILIES))
    good = sorted(p[y] for y, p in held if y < len(FAMILIES))
    if quiet:
        model.candidate = max(0.5, float(np.quantile(quiet, 1 - QUIET)))
    if good:
        model.sure = min(0.5, float(np.quantile(good, 1 - KEEP)))
    return model


FOUND = "array<struct<family:string,start:int,end:int,probability:double,similarity:double>>"


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with ``licences``: for each licence paragraph its family or
    ``unknown``, its words (from, to), probability and template similarity
    (both 1 where an SPDX tag declares it); overlapping windows of a family are one.
    Very long texts are read whole, window by window; an empty table stays empty.
    Null and empty texts have none; each row is judged on its own; an input
    column named licences is replaced."""
    docs = docs.drop("licences")
    out = docs.withColumn("licences", F.lit(None).cast(FOUND))
    names, at = docs.columns, docs.columns.index(text)
    kind = _arrow(f"f {FOUND}").field("f").type
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        m = sent.value
        for batch in batches:
            column = batch.column(at).cast(pa.string())
            found: list[list] = []
            for a, b in A.slices(column):
                found += _judge(Paragraphs(column.slice(a, b - a)), m, b - a)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*names, "licences"])

    return docs.mapInArrow(task, out.schema)


def _merged(found: list[dict]) -> list[dict]:
    """One entry for overlapping windows of a family; an unknown one only
    where no family was found."""
    out: list[dict] = []
    for x in sorted(found, key=lambda x: (x["family"] == UNKNOWN, x["family"], x["start"])):
        last = out[-1] if out and out[-1]["family"] == x["family"] else None
        if x["family"] == UNKNOWN and any(y["family"] != UNKNOWN and y["start"] < x["end"] and x["start"] < y["end"] for y in out):
            continue
        if last and x["start"] < last["end"]:
            last |= {"end": max(last["end"], x["end"]), "probability": max(last["probability"], x["probability"]),
                     "similarity": max(last["similarity"], x["similarity"])}
        else:
            out.append(dict(x))
    return sorted(out, key=lambda x: (x["start"], x["end"], x["family"]))


def spdx_family(identifier: str) -> str:
    """Family of an SPDX identifier (any case; a trailing + is allowed)."""
    name = identifier.lower().removesuffix("+")
    return next((f for f, pattern in SPDX.items() if re.fullmatch(pattern, name)), UNKNOWN)


def _declared(p: Paragraphs, rows: int) -> list[list]:
    """Licences that SPDX tags declare: one entry for each identifier of the
    expression (an exception after ``with`` is none), over the tag's words."""
    out: list[list] = [[] for _ in range(rows)]
    w, data = p.words, p.words.data.tobytes()
    at = data.find(SPDX_TAG)
    while at >= 0:
        text = int(np.searchsorted(w.offs, at, "right")) - 1
        match = SPDX_EXPRESSION.match(data, at, int(w.offs[text + 1]))
        if match:
            terms = match.group(1).decode().replace("(", "").replace(")", "").split()
            names = [t for before, t in zip(["", *terms], terms) if t not in ("and", "or", "with") and before != "with"]
            a, b = (int(x) for x in np.searchsorted(w.start, [match.start(), match.end()]) - w.first[text])
            out[text] += [{"family": f, "start": a, "end": b, "probability": 1.0, "similarity": 1.0}
                          for f in sorted({spdx_family(n) for n in names if n not in SPDX_NOTHING})]
        at = data.find(SPDX_TAG, at + 1)
    return out


def _judge(p: Paragraphs, m: Model, rows: int) -> list[list]:
    out = _declared(p, rows)
    prob = m.probabilities(p)
    if not len(prob):
        return out
    for i in np.flatnonzero(1 - prob[:, -1] >= m.candidate):
        best = int(prob[i, :-1].argmax())
        family, chance = m.classes[best], float(prob[i, best])
        alike = similarity(p.tokens(i), family)
        if chance < m.sure or alike < CONFIRM:
            alike = max(similarity(p.tokens(i), f) for f in FAMILIES)
            if alike < HINT:
                continue
            family = UNKNOWN
        first = int(p.words.first[p.text[i]])
        out[p.text[i]].append({"family": family, "start": int(p.start[i]) - first, "end": int(p.end[i]) - first,
                               "probability": chance, "similarity": float(alike)})
    return [_merged(x) if len(x) > 1 else x for x in out]

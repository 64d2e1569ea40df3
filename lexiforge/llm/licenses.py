"""Licence scan: a trained paragraph classifier confirmed by template comparison.

Paragraphs (lines, and runs of lines up to a blank one, of a notice that is
wrapped) become sparse word 1- and 2-grams over the vocabulary of the
training paragraphs.  A softmax regression names the licence family; an explicit
unknown class, trained on confusable prose and on a bounded sample of corpus
lines, and a temperature and threshold fitted on held-out paragraphs calibrate
it.  A prediction stands only if the paragraph covers enough of the weighted
words of one of the family's templates.

A wrapped notice is sought in windows of consecutive lines that no single line of
them settles, up to twice the words of the longest template; the shortest such
window is reported by its first line.  Comment marks are no words.  ``n_paragraphs``
counts lines that are not blank.

Lines without any licence word have no features, so they are unknown by the
model itself; that test is made first, on whole texts.

A paragraph that denies or asks (never, not, should ...) is unknown.

Edge cases: ties of families go to the first by name of the table; rows without an
id are scanned like others; null and empty texts have no paragraphs; repeated lines are found
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import smallest, tidied

#: Key paragraphs of public licences and usual notices, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU GPL version 2",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Licensed under CC BY-SA 4.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights, CC0 1.0 Universal public domain dedication", "SPDX-License-Identifier: CC0-1.0"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License", "SPDX-License-Identifier: ISC"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "SPDX-License-Identifier: Unlicense"],
    "Proprietary": ["Copyright. All rights reserved", "All rights reserved. Unauthorized copying of this file is strictly prohibited, proprietary and confidential"],
}
#: Names by family, for sentences that speak of a licence without granting it.
NAMES = {
    "MIT": "the MIT License", "Apache-2.0": "the Apache License, Version 2.0", "GPL": "the GNU General Public License", "LGPL": "the GNU Lesser General Public License",
    "AGPL": "the GNU Affero General Public License", "BSD": "the BSD 3-Clause License", "MPL-2.0": "the Mozilla Public License, version 2.0", "CC-BY": "a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA": "a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-NC": "a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC0": "the CC0 1.0 Universal public domain dedication", "ISC": "the ISC License", "Unlicense": "the Unlicense",
}
DENIALS = [
    "Never license your software under {} without asking a lawyer first", "This software is not licensed under {}", "It was never released under {}",
    "We do not distribute this work under {}", "Should you release your program under {}?", "This program is no longer available under {}", "Nothing here is licensed under {}",
    "The library isn't offered under {}", "That file wasn't released under {}", "Our tool doesn't come under {}", "You cannot use it under {}", "Neither part is licensed under {}",
]
#: Words that turn a grant into a denial or a question; the model sees them next to any licence word.
TURNS = frozenset(b"not never no nothing neither nor without should whether unless instead".split())
#: Stems of contracted denials count as the plain one.
CONTRACTED = frozenset(b"isn wasn aren weren doesn don didn hasn haven cannot won".split())
#: Prose that uses licence words without granting one.
CONFUSERS = [
    "the driver lost his license near the public library", "a version of the general report was released in may", "work on the new software is free of trouble",
    "permission to enter the source of the river", "all the copies were sold under the bridge", "public opinion and creative work", "the common source of the terms",
    "the mozart version of the public concert", "rights of the people and the general will", "modify the form and use the code", "apache helicopters were released in 2004",
    "he was licensed to sell by the city", "this program is on television", "software is used in source and binary stars",
]
STOP = frozenset("the a an of and or to in is are this that it for on with by be as at from you your any may can under work was he were his all near new lost new sold".split())
UNKNOWN = "unknown"
_PUNCT = bytes(b if chr(b).isalnum() or b >= 128 or b == 10 else 32 for b in range(256)).lower()


def _words(paragraph: bytes) -> list[bytes]:
    return paragraph.translate(_PUNCT).lower().split()


def _grams(words: list[bytes]) -> list[bytes]:
    words = [b"not" if w in CONTRACTED else w for w in words]
    plain = [w for w in words if w.decode("utf-8", "replace") not in STOP]
    return plain + [b"%b %b" % p for p in zip(words, words[1:], strict=False) if p[0] in plain or p[1] in plain]


@dataclass
class Model:
    families: list[str]
    vocabulary: dict[bytes, int]
    weights: np.ndarray
    bias: np.ndarray
    threshold: float
    templates: dict[str, list[dict[bytes, float]]]
    triggers: frozenset[bytes]

    def predict(self, words: list[bytes]) -> tuple[str, float]:
        ids = [self.vocabulary[g] for g in set(_grams(words)) if g in self.vocabulary]
        z = self.weights[ids].sum(0) + self.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        family = self.families[k]
        if family == UNKNOWN or p[k] < self.threshold or self.confirm(family, words) < 0.6:
            return UNKNOWN, float(p[k])
        return family, float(p[k])

    def confirm(self, family: str, words: list[bytes]) -> float:
        """The largest share of a template's word weight that the paragraph covers."""
        own = set(words)
        return max(sum(w for t, w in template.items() if t in own) / sum(template.values()) for template in self.templates[family])


def _wrapped(m: Model, lines: list[list[bytes]], settled: set[int]) -> Iterator[tuple[int, str, float]]:
    """First line, family and confidence of the notices that go over several lines of a paragraph."""
    most = 2 * max(len(_words(t.encode())) for texts in TEMPLATES.values() for t in texts)
    own = [not m.triggers.isdisjoint(ws) for ws in lines]
    i = 0
    while i < len(lines):
        found, words = None, list(lines[i])
        for j in range(i + 1, len(lines) if own[i] and i not in settled else 0):
            if not lines[j] or j in settled or len(words) + len(lines[j]) > most:
                break
            words += lines[j]
            if own[j] and (found := m.predict(words))[0] != UNKNOWN:
                break
        if found is None or found[0] == UNKNOWN:
            i += 1
            continue
        for k in range(i + 1, j):  # the lines before the notice are not part of it
            shorter = m.predict([w for ws in lines[k : j + 1] for w in ws])
            if own[k] and shorter[0] == found[0]:
                i, found = k, shorter
        yield i, *found
        i = j + 1


def _variants() -> list[tuple[str, list[bytes]]]:
    rows, lead = [], ["", "Notice: ", "# ", "This file is part of the project. ", "Copyright 2021 the authors. "]
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = _words(text.encode())
            rows += [(family, _words((pre + text).encode())) for pre in lead]
            for k in range(0, len(words), 3):
                if len(words) > 8:
                    rows.append((family, words[:k] + words[k + 1 :]))
    return rows


def fit(negatives: list[str] = (), epochs: int = 400, seed: int = 7) -> Model:
    """Softmax regression on template variants, confusers and a bounded sample of corpus lines."""
    rows = _variants()
    licence_words = {w for _, ws in rows for w in ws}
    rows += [(UNKNOWN, _words(t.encode())) for t in CONFUSERS] * 3
    turned = [_words(d.format(name).encode()) for name in NAMES.values() for d in DENIALS]
    rows += [(UNKNOWN, ws) for ws in turned] * 2
    for text in negatives:
        ws = _words(text.encode())
        if sum(w in licence_words and w.decode("utf-8", "replace") not in STOP for w in ws) < 3:
            rows.append((UNKNOWN, ws))
    families = [UNKNOWN, *TEMPLATES]
    vocabulary: dict[bytes, int] = {}
    for family, ws in rows:
        if family != UNKNOWN:
            for g in _grams(ws):
                vocabulary.setdefault(g, len(vocabulary))
    licensed = len(vocabulary)
    for w in sorted(TURNS):
        vocabulary.setdefault(w, len(vocabulary))
    x = np.zeros((len(rows), len(vocabulary)), "f4")
    y = np.array([families.index(f) for f, _ in rows])
    for i, (_, ws) in enumerate(rows):
        x[i, [vocabulary[g] for g in set(_grams(ws)) if g in vocabulary]] = 1
    held = np.random.default_rng(seed).random(len(rows)) < 0.2
    w, b = np.zeros((x.shape[1], len(families)), "f4"), np.zeros(len(families), "f4")
    b[0] = 2.0
    one = np.eye(len(families), dtype="f4")[y]
    xt, ot = x[~held], one[~held]
    for _ in range(epochs):
        z = xt @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - ot) / len(xt)
        w -= 4.0 * (xt.T @ g + 2e-4 * w)
        b[1:] -= 1.0 * g.sum(0)[1:]  # the unknown class keeps its head start: no features, no licence
    z = x[held] @ w + b

    def nll(t: float) -> float:
        s = z * t
        s = s - s.max(1, keepdims=True)
        return float(-(s[np.arange(len(s)), y[held]] - np.log(np.exp(s).sum(1))).mean())

    t = min(np.linspace(0.3, 3.0, 28), key=nll)  # calibration on held-out paragraphs
    p = np.exp(t * z - (t * z).max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    false = p[(y[held] == 0)][:, 1:].max(initial=0.0)
    counts: dict[bytes, int] = {}
    for texts in TEMPLATES.values():
        for u in {u for text in texts for u in _words(text.encode())}:
            counts[u] = counts.get(u, 0) + 1
    weigh = lambda text: {u: 1.0 / counts[u] for u in _words(text.encode()) if u.decode() not in STOP}
    templates = {f: [weigh(text) for text in texts] for f, texts in TEMPLATES.items()}
    triggers = frozenset(u for g in list(vocabulary)[:licensed] for u in g.split() if u.decode("utf-8", "replace") not in STOP)
    return Model(families, vocabulary, (w * t).astype("f8"), (b * t).astype("f8"), min(0.9, max(0.5, float(false) + 0.01)), templates, triggers)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", negative_rows: int = 200, negative_chars: int = 4000, negative_lines: int = 5) -> DataFrame:
    """doc_id, n_paragraphs, and arrays of the paragraphs found: index, family, confidence.

    ``negative_rows`` bounds the sample of rows (the first by a hash of the id)
    whose lines teach the classifier what is no licence; ``negative_chars`` and
    ``negative_lines`` bound what is taken of each.  The scan reads whole texts.
    """
    hashed = docs.select((F.xxhash64(F.col(id_col), F.lit(11)) / F.lit(2.0**64)).alias("h"), F.substring(F.col(text_col), 1, negative_chars).alias("t"))
    lines = [ln for r in smallest(hashed, "h", negative_rows) if r["t"] for ln in r["t"].split("\n")[:negative_lines]]
    model = docs.sparkSession.sparkContext.broadcast(fit(lines))

    @tidied
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            found, n = [], []
            for text in batch.column(1).to_pylist():
                own, lines = [], (text or "").encode("utf-8", "replace").translate(_PUNCT).lower().split(b"\n")
                n.append(sum(1 for ln in lines if ln.strip()))
                if not m.triggers.isdisjoint(b" ".join(lines).split()):
                    for i, line in enumerate(lines):
                        words = line.split()
                        if not m.triggers.isdisjoint(words):
                            family, p = m.predict(words)
                            if family != UNKNOWN:
                                own.append({"paragraph": i, "family": family, "confidence": p})
                    wrapped = _wrapped(m, [ln.split() for ln in lines], {h["paragraph"] for h in own})
                    own += [{"paragraph": i, "family": family, "confidence": p} for i, family, p in wrapped]
                    own.sort(key=lambda h: h["paragraph"])
                found.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, hits)], ["doc_id", "n_paragraphs", "hits"])

    hits = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("confidence", pa.float64())]))
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        find, "doc_id long, n_paragraphs long, hits array<struct<paragraph:int,family:string,confidence:double>>"
    )


def op4_license_scan(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("hits").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["family"]))), ",").alias("families"),
        F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["paragraph"], h["family"])), ",").alias("paragraphs"),
    )

"""Licence scan by a trained paragraph classifier, confirmed by templates (operator 6).

A text's paragraphs are its lines. A logistic regression over hashed word uni- and bigrams tells the
licence families, ``unknown`` (licences of no family) and ``none`` apart. It learns from variations of the
families' and of other licences' notices (below) and
from a bounded sample of ordinary paragraphs of the corpus itself: half of the ``NEGATIVES``
distinct paragraphs of smallest hash that resemble no notice. A corpus may hold licences of its own among them:
each half of the sample is scored by a model that learned from the other half, and what looks like a licence is not taught as ordinary.

What is a licence at all is calibrated on licences the model has not seen: the families are dealt to ``FOLDS`` folds,
each fold's notices are scored by a model that learned without them, and the threshold is the score that
``UNSEEN_RECALL`` of them reach. Then all paragraphs of the corpus that resemble no notice and were not learned from
are scored, and the threshold rises to where ``FALSE_RATE`` of the ordinary ones would pass. That place is found from the median and the
``BODY`` quantile of their log odds as a normal distribution's, as the top of the scores may be licences no notice names. A paragraph that passes
is held against the templates of its predicted family: if one of them
has at least ``SIMILARITY`` of its shingles (five words, or all of a shorter one) in the paragraph,
the family is confirmed; else the licence is ``unknown``. Families that resemble a wrapped notice
equally go by the model's score, then by name.

Notices wrapped over lines. Within a block (lines up to one without words) the shingles of all
templates are sought over the joined lines. A run of lines that has ``SIMILARITY`` of a template's
shingles only together is scored as one paragraph; its family is the one it resembles most. It takes
the place of its lines' own ``unknown`` ones and of those of its family.

The model is a table of fixed size (``FEATURES`` by families), trained on the driver from the bounded
sample; every paragraph of every text is scored. Nothing is shuffled but the sample and counts of scores.

Words are runs of letters and digits in lower case. Defined cases: null and empty texts have no
paragraphs and no licence; lines without words are no paragraphs; repeated rows are scanned each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.llm.columns import GOLD, MIX1, chunks, mix, per_row, word_hashes
from burnup.llm.decontaminate import WORD, shingles

FEATURES = 1 << 15
NEGATIVES, VARIANTS, FALSE_RATE = 4000, 80, 0.001
FOLDS, UNSEEN_RECALL, BODY = 4, 0.9, 0.9
SHINGLE, SIMILARITY = 5, 0.8
#: A paragraph that has this part of a template's shingles is no ordinary one.
RESEMBLES = 0.5
#: Scores are counted by the log of their odds, in so many steps to 1 and up to so many.
STEPS, MOST_STEPS = 256, 1 << 13
UNKNOWN = "unknown"

#: Notices by licence family, as their publishers word them.
NOTICES: dict[str, tuple[str, ...]] = {
    "AGPL": ("GNU Affero General Public License", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             "Licensed under the AGPL"),
    "Apache-2.0": ("Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "BSD": ("BSD 3-Clause License", "BSD 2-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD License",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    "CC-BY": ("CC BY 4.0", "Creative Commons Attribution 4.0 International", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0": ("CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "Dedicated to the public domain under CC0"),
    "GPL": ("GNU General Public License", "This work is licensed under the GNU General Public License, version 3", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Licensed under the GPL",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "ISC": ("ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License",
            "provided that the above copyright notice and this permission notice appear in all copies.",
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    "LGPL": ("GNU Lesser General Public License", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "MIT": ("MIT License", "Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    "Proprietary": ("All rights reserved", "Copyright All rights reserved. No part of this work may be reproduced without permission"),
}
#: Notices of licences that are no family here; they teach the class ``unknown``.
OTHERS = (
    "Eclipse Public License, Version 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License",
    "Boost Software License, Version 1.0", "Distributed under the Boost Software License, Version 1.0.",
    "This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "European Union Public Licence v. 1.2", "Licensed under the EUPL, Version 1.2", "SIL Open Font License, Version 1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "zlib License", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Artistic License 2.0", "Common Development and Distribution License", "Microsoft Public License", "Do What The Fuck You Want To Public License", "Open Database License",
)
#: Words around a notice's core in training.
FRAMES = ("{}", "{}.", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "Distributed under {}", "Copyright 2020 Some Author. {}", "{} See the LICENSE file for details.")
FAMILIES = sorted(NOTICES)
#: The model's classes but ``none``, which is the last one.
KINDS = [*FAMILIES, UNKNOWN]
WORDING = {**NOTICES, UNKNOWN: OTHERS}


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", text.lower())


def shingles_of(words: list[str]) -> set[tuple[str, ...]]:
    k = min(SHINGLE, len(words))
    return {tuple(words[i: i + k]) for i in range(len(words) - k + 1)} if k else set()


@lru_cache(maxsize=1)
def templates() -> dict[str, list[tuple[int, set[tuple[str, ...]]]]]:
    return {f: [(min(SHINGLE, len(words_of(t))), shingles_of(words_of(t))) for t in WORDING[f]] for f in KINDS}


def resemblance(words: list[str], family: str) -> float:
    """Largest part of one of the family's templates whose shingles the paragraph has."""
    best = 0.0
    for k, wanted in templates()[family]:
        have = {tuple(words[i: i + k]) for i in range(len(words) - k + 1)}
        best = max(best, len(wanted & have) / len(wanted))
    return best


class Lines(NamedTuple):
    """A chunk's lines with words: hashes of all words, and of each line its words, row, bytes in the chunk and block."""

    a: int
    b: int
    buf: np.ndarray
    bounds: np.ndarray
    h: np.ndarray
    n: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    block: np.ndarray

    def text(self, i: int, j: int) -> str:
        """Lines i to j."""
        return self.buf[self.begin[i]: self.end[j]].tobytes().decode("utf-8", "replace")


def lines_of(column: pa.Array) -> Iterator[Lines]:
    for a, b, buf, bounds in chunks(pc.utf8_lower(column.cast(pa.large_string())), b"\n"):
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[1:] = WORD[buf]
        step = np.diff(inside)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        lines = np.append(0, np.flatnonzero(buf == 10) + 1)
        n = per_row(starts, lines)
        some = np.flatnonzero(n)
        row = np.searchsorted(bounds, lines[some], "right") - 1
        new = (np.diff(some, prepend=-2) != 1) | (np.diff(row, prepend=-1) != 0)
        yield Lines(a, b, buf, bounds, word_hashes(buf, starts, ends), n[some], row, lines[some], lines[some + 1] - 1, np.cumsum(new))


def features(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of paragraphs of ``n`` words each, and the first one of each paragraph."""
    first = np.cumsum(n) - n
    pair = mix(h * MIX1 + np.concatenate([h[1:], h[:1]]) + GOLD)
    pair[first + n - 1] = mix(h[first + n - 1] ^ GOLD)  # the last word with the end
    f = np.stack([h, pair], axis=1).ravel() & np.uint64(FEATURES - 1)
    return f.astype(np.int32), 2 * first


def paragraphs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: features, first feature of each paragraph, its row, and first and last byte in the row."""
    for x in lines_of(column):
        yield x.a, x.b, *features(x.h, x.n), x.row, np.stack([x.begin, x.end], axis=1) - x.bounds[x.row][:, None]


@lru_cache(maxsize=1)
def _sought() -> tuple[list[int], list[tuple[int, np.ndarray, list[list[tuple[int, int]]]]]]:
    """Number of shingles of each template; by shingle size the hashes, and of each its (template, shingle)."""
    sizes, by_size = [], {}
    for family in KINDS:
        for text in WORDING[family]:
            h = next(lines_of(pa.array([text]))).h
            k = min(SHINGLE, len(h))
            distinct = np.unique(shingles(h, k)).tolist()
            for i, x in enumerate(distinct):
                by_size.setdefault(k, {}).setdefault(x, []).append((len(sizes), i))
            sizes.append(len(distinct))
    return sizes, [(k, np.array(sorted(known), np.uint64), [known[x] for x in sorted(known)]) for k, known in sorted(by_size.items())]


def hits(h: np.ndarray, unit: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(first word, size, its (template, shingle)s) of each shingle of a template within one unit."""
    for k, known, owners in _sought()[1]:
        if len(h) < k:
            continue
        sh = shingles(h, k)
        maybe = np.zeros(1 << 16, bool)
        maybe[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
        place = np.flatnonzero(maybe[(sh & np.uint64(0xFFFF)).astype(np.int64)])
        place = place[unit[place] == unit[place + k - 1]]
        at = np.minimum(np.searchsorted(known, sh[place]), len(known) - 1)
        for w, i in zip(place[known[at] == sh[place]].tolist(), at[known[at] == sh[place]].tolist(), strict=True):
            yield w, k, owners[i]


def wrapped(x: Lines) -> list[tuple[int, int]]:
    """Runs of lines (first, last) that only together have a template's shingles; each word is in one run's notice."""
    line = np.repeat(np.arange(len(x.n)), x.n)
    sizes, _ = _sought()
    groups: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for w, k, owners in hits(x.h, x.block[line]):
        for template, shingle in owners:
            groups.setdefault((int(x.block[line[w]]), template), []).append((w, w + k - 1, shingle))
    found = []
    for (_, template), some in groups.items():
        some.sort()
        if line[some[0][0]] == line[some[-1][1]]:
            continue
        lo, have = 0, {}
        for hi, (_, last, shingle) in enumerate(some):
            if hi < lo:  # of the notice before
                continue
            have[shingle] = have.get(shingle, 0) + 1
            if len(have) < SIMILARITY * sizes[template]:
                continue
            while have[some[lo][2]] > 1 or len(have) - 1 >= SIMILARITY * sizes[template]:
                have[some[lo][2]] -= 1
                if not have[some[lo][2]]:
                    del have[some[lo][2]]
                lo += 1
            # the rest of the notice, as far as it goes on
            end = hi
            while end + 1 < len(some) and some[end + 1][0] <= some[end][1] and some[end + 1][2] not in have:
                end += 1
                have[some[end][2]] = 1
            start = some[lo][0]
            while lo and some[lo - 1][1] >= start and some[lo - 1][2] not in have:
                lo -= 1
                start = some[lo][0]
                have[some[lo][2]] = 1
            if line[start] != line[last := some[end][1]]:
                found.append((len(have) / sizes[template], last - start, start, last))
            lo, have = end + 1, {}
    taken: list[tuple[int, int]] = []  # in order and apart, so only the neighbours can overlap
    for _, _, start, last in sorted(found, reverse=True):
        at = bisect.bisect(taken, (start, last))
        if (not at or taken[at - 1][1] < start) and (at == len(taken) or last < taken[at][0]):
            taken.insert(at, (start, last))
    return sorted({(int(line[start]), int(line[last])) for start, last in taken})


def ordinary(x: Lines) -> np.ndarray:
    """Which lines resemble no notice, alone or with the lines around them."""
    line = np.repeat(np.arange(len(x.n)), x.n)
    out = np.ones(len(x.n), bool)
    for i in {int(line[w]) for w, _, _ in hits(x.h, line)}:  # the others have no shingle of a notice
        words = words_of(x.text(i, i))
        out[i] = max(resemblance(words, f) for f in KINDS) < RESEMBLES
    for i, j in wrapped(x):
        out[i: j + 1] = False
    return out


def line_keys(x: Lines) -> np.ndarray:
    return word_hashes(x.buf, x.begin, x.end)


def probabilities(weights: np.ndarray, f: np.ndarray, first: np.ndarray) -> np.ndarray:
    """P(class | paragraph); the last class is ``none``, the last row of weights the bias."""
    n = np.diff(np.append(first, len(f)))
    z = np.add.reduceat(weights[f], first, axis=0) / np.sqrt(n)[:, None] + weights[-1]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: np.ndarray, rounds: int = 100, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Multinomial logistic regression by gradient descent with per-weight steps (Adagrad)."""
    f, first = (np.concatenate(x) for x in zip(*_features(texts), strict=True))
    classes = len(KINDS) + 1
    n = np.diff(np.append(first, len(f)))
    used, f = np.unique(f, return_inverse=True)  # the weights of the others stay zero
    w, seen = np.zeros((len(used) + 1, classes), np.float32), np.full((len(used) + 1, classes), 1e-6, np.float32)
    truth = np.eye(classes, dtype=np.float32)[labels]
    order = np.argsort(f, kind="stable")
    owner = np.repeat(np.arange(len(n)), n)[order]
    at = np.searchsorted(f[order], np.arange(len(used)))
    for _ in range(rounds):
        error = (probabilities(w, f, first) - truth).astype(np.float32) / len(n)
        g = np.empty_like(w)
        g[:-1] = np.add.reduceat((error / np.sqrt(n)[:, None].astype(np.float32))[owner], at, axis=0)
        g[-1] = error.sum(axis=0)
        g += decay / len(n) * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    out = np.zeros((FEATURES + 1, classes), np.float32)
    out[used], out[-1] = w[:-1], w[-1]
    return out


def _features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    done = 0
    for _, _, f, first, _, _ in paragraphs(pa.array([" ".join(t.split("\n")) for t in texts], pa.string())):
        yield f, first + done
        done += len(f)


def variants(seed: int = 7) -> tuple[list[str], list[int]]:
    """Training paragraphs of each kind: framed notices, some without a word, some among other words."""
    r = random.Random(seed)
    texts, labels = [], []
    for i, family in enumerate(KINDS):
        for _ in range(VARIANTS):
            words = r.choice(FRAMES).format(r.choice(WORDING[family])).split()
            if len(words) > 8 and r.random() < 0.4:
                words.pop(r.randrange(len(words)))
            texts.append(" ".join(words))
            labels.append(i)
    return texts, labels


def _sample(docs: DataFrame) -> list[str]:
    """The NEGATIVES distinct ordinary lines of smallest hash, or all there are."""
    line = F.explode(F.split("text", "\n")).alias("line")
    # a bound of the hash that lets somewhat more than NEGATIVES distinct lines pass
    share = min(1.0, 1.5 * NEGATIVES / max(1, docs.select(line).agg(F.approx_count_distinct("line", 0.02)).first()[0]))
    while True:
        bound = min(int(share * (1 << 64)), (1 << 64) - 1)

        def run(batches: Iterator[pa.RecordBatch], bound: int = bound) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x in lines_of(batch["text"]):
                    key = line_keys(x)
                    some = np.flatnonzero((key <= np.uint64(bound)) & ordinary(x))
                    yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array([x.text(i, i) for i in some.tolist()], pa.string())], names=["key", "line"])

        got = docs.select("text").mapInArrow(run, "key long, line string").distinct().collect()
        if len(got) >= NEGATIVES or share == 1.0:
            return [x.line for x in sorted(got, key=lambda x: (x.key % (1 << 64), x.line))[:NEGATIVES]]
        share = min(1.0, 4 * share)


def log_odds(p: np.ndarray) -> np.ndarray:
    """Of being a licence at all, from the probabilities of the classes."""
    return np.log(np.maximum(1 - p[:, -1], 1e-300)) - np.log(np.maximum(p[:, -1], 1e-300))


def unseen_odds(texts: list[str], labels: np.ndarray, learned: list[str]) -> np.ndarray:
    """Log odds of each fold's notices under a model that learned without the fold's families."""
    out = []
    for fold in range(FOLDS):
        mine = labels % FOLDS == fold
        some = [t for t, m in zip(texts, mine, strict=True) if not m]
        weights = fit(some + learned, np.concatenate([labels[~mine], np.full(len(learned), len(KINDS))]))
        f, first = (np.concatenate(x) for x in zip(*_features([t for t, m in zip(texts, mine, strict=True) if m]), strict=True))
        out.append(log_odds(probabilities(weights, f, first)))
    return np.concatenate(out)


def ordinary_sample(texts: list[str], labels: np.ndarray, learned: list[str]) -> list[str]:
    """The sample without what a model that learned from the other half of it takes for a licence."""
    out = []
    for half in (0, 1):
        mine, others = learned[half::2], learned[1 - half:: 2]
        if not mine:
            continue
        weights = fit(texts + others, np.concatenate([labels, np.full(len(others), len(KINDS))]))
        f, first = (np.concatenate(x) for x in zip(*_features(mine), strict=True))
        out += [t for t, odds in zip(mine, log_odds(probabilities(weights, f, first)), strict=True) if odds <= 0] if others else mine
    return out


def tail(counts: list[tuple[int, int]]) -> float:
    """Log odds that FALSE_RATE of the ordinary lines exceed, from the body of the (step, number)s in order."""
    if not counts:
        return 0.0
    step, n = (np.array(x) for x in zip(*counts, strict=True))
    share = np.cumsum(n) / n.sum()
    middle, body = (int(step[min(np.searchsorted(share, q), len(step) - 1)]) / STEPS for q in (0.5, BODY))
    z = NormalDist().inv_cdf
    return middle + (body - middle) * z(1 - FALSE_RATE) / z(BODY)


def _least(docs: DataFrame, weights: np.ndarray, learned: list[str], floor: float) -> float:
    """The score of ``floor`` log odds, or more if FALSE_RATE of all ordinary lines not learned from would exceed it."""
    known = np.unique(np.concatenate([line_keys(x) for x in lines_of(pa.array(learned, pa.string()))] or [np.zeros(0, np.uint64)]))
    model = docs.sparkSession.sparkContext.broadcast((weights, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known = model.value
        for batch in batches:
            for x in lines_of(batch["text"]):
                use = ordinary(x) & ~np.isin(line_keys(x), known)
                if not use.any():
                    continue
                odds = log_odds(probabilities(weights, *features(x.h, x.n))[use])
                step, n = np.unique(np.clip(np.ceil(odds * STEPS), -MOST_STEPS, MOST_STEPS).astype(np.int32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(n.astype(np.int64))], names=["step", "n"])

    counts = sorted((x.step, x.n) for x in docs.select("text").mapInArrow(run, "step int, n long").groupBy("step").agg(F.sum("n").alias("n")).collect())
    return float(1 / (1 + np.exp(-max(floor, tail(counts)))))


def train(docs: DataFrame) -> tuple[np.ndarray, float]:
    """Weights, and the score beyond which a paragraph is a licence."""
    sampled = _sample(docs)[::2]
    texts, labels = variants()
    labels = np.array(labels)
    learned = ordinary_sample(texts, labels, sampled)
    weights = fit(texts + learned, np.concatenate([labels, np.full(len(learned), len(KINDS))]))
    floor = float(np.quantile(unseen_odds(texts, labels, learned), 1 - UNSEEN_RECALL))
    return weights, _least(docs, weights, sampled, floor)


FOUND = "array<struct<family:string,first_byte:bigint,end_byte:bigint,score:double,resemblance:double>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, licences: family (or ``unknown``), place, score and resemblance of each licence paragraph.

    Places are bytes of the text in lower case.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(train(rows.where("text is not null")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, least = model.value
        for batch in batches:
            n, found = np.zeros(len(batch), np.int64), [[] for _ in range(len(batch))]
            for x in lines_of(batch["text"]):
                n[x.a: x.b] = np.bincount(x.row, minlength=x.b - x.a)
                if not len(x.n):
                    continue
                ends = np.cumsum(x.n)
                p = probabilities(weights, *features(x.h, x.n))
                runs, covered = [], {}
                for i, j in wrapped(x):
                    h = x.h[ends[i] - x.n[i]: ends[j]]
                    q = probabilities(weights, *features(h, np.array([len(h)])))[0]
                    if 1 - q[-1] > least:
                        words = words_of(x.text(i, j))
                        near, _, family = max((resemblance(words, f), q[k], f) for k, f in enumerate(KINDS))
                        runs.append((i, j, family, float(1 - q[-1]), near))
                        for line in range(i, j + 1):
                            covered.setdefault(line, {UNKNOWN}).add(family)
                single = []
                for i in np.flatnonzero(1 - p[:, -1] > least).tolist():
                    family = KINDS[int(p[i, :-1].argmax())]
                    near = resemblance(words_of(x.text(i, i)), family)
                    family = family if near >= SIMILARITY else UNKNOWN
                    if family not in covered.get(i, ()):
                        single.append((i, i, family, float(1 - p[i, -1]), near))
                for i, j, family, score, near in sorted(single + runs):
                    at = x.bounds[x.row[i]]
                    found[x.a + int(x.row[i])].append({"family": family, "first_byte": int(x.begin[i] - at), "end_byte": int(x.end[j] - at), "score": score, "resemblance": near})
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n), pa.array(found, kind)], names=["doc_id", "n_paragraphs", "licences"])

    kind = pa.list_(pa.struct([("family", pa.string()), ("first_byte", pa.int64()), ("end_byte", pa.int64()), ("score", pa.float64()), ("resemblance", pa.float64())]))
    return rows.mapInArrow(run, f"doc_id long, n_paragraphs long, licences {FOUND}")

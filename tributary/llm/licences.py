"""Licence notices in documents by a trained paragraph classifier.

Paragraphs are lines with a word. A multinomial logistic regression over sparse word n-grams (one to three words, those of the templates)
names a licence family or `unknown`. It is trained here: on the templates below with words dropped and put in, against paragraphs of the corpus
(a bounded sample) and sentences that only talk of licences. A temperature fitted on a part kept aside calibrates its probabilities, that
of `unknown` among them. A family is reported only if comparison with its templates confirms it: enough of a template's word pairs stand
in the paragraph, or nearly all of the paragraph's pairs stand in a template (a wrapped line).

A paragraph may be long and hold several notices. So every stretch of a template's length that has enough of its pairs is classified by
itself as well, and the families that are likely there are reported too, each once a paragraph. Of stretches that overlap the best one counts; a
family of the whole paragraph gives way if its own stretches all lost.

Whole texts are read, however long. Null and empty texts have no paragraphs. Documents are independent: nothing is shuffled when scoring.
Repeated rows stay repeated, null ids are kept, other columns are not read. An empty table gives an empty result and is trained without corpus paragraphs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import hash_sample, over_batches, utf8

#: Notices by family, as their licences give or recommend them. Fixed values.
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "Released under the Apache License, version 2.0.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0 Universal.",
        "Released into the public domain under CC0.",
    ],
    "gpl": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL v3.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, for any purpose, commercial or non-commercial, and by any means.",
    ],
}
#: Sentences with the words of licences that are none.
TALK = [
    "The driver renewed the license last year.", "A public notice was posted at the door.", "She works in the software industry.",
    "Version 2.0 was released in May.", "The general public may use the hall free of charge.", "No permission is required to enter.",
    "They were licensed to sell food under the new law.", "The work was done by a free person.", "Conditions and limitations may apply.",
    "The commons were open to all kinds of people.", "The MIT campus is in Cambridge.", "The Apache helicopter is under repair.",
    "This is a copy of the list.", "Use the following form.", "The license was published by the city.", "See the file for language and law.",
]

UNKNOWN = "unknown"
#: Corpus paragraphs to train on, their greatest length in bytes, variants of a template, words of an n-gram.
PARAGRAPHS, LENGTH, VARIANTS, WORDS = 4_000, 2_000, 24, 3
#: Share of word pairs that confirms a family: of a template's pairs, or of the paragraph's if it has at least this many.
CONFIRM, CONFIRM_PART, PART_PAIRS = 0.6, 0.9, 5
#: Least probability of a family in a stretch; most words of a stretch for each word of the template, and besides.
LIKELY, STRETCH, BESIDES = 0.25, 1.25, 3

#: Letters, digits and other scripts stay (A-Z as a-z), line ends stay, the rest separates words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 or b == 10 else 32 for b in range(256))


def words_of(paragraph: bytes) -> list[bytes]:
    return paragraph.translate(FOLD).split()


def pairs_of(words: list[bytes]) -> frozenset:
    return frozenset(zip(words, words[1:])) or frozenset((w,) for w in words)


def grams(words: list[bytes]) -> set[tuple]:
    return {tuple(words[i : i + n]) for n in range(1, WORDS + 1) for i in range(len(words) - n + 1)}


def similarity(pairs: frozenset, templates: list[frozenset]) -> float:
    """Best agreement with a template, as the share that `CONFIRM` is held against."""
    best = 0.0
    for t in templates:
        both = len(pairs & t)
        best = max(best, both / len(t))
        if len(pairs) >= PART_PAIRS and both >= CONFIRM_PART * len(pairs):
            best = max(best, both / len(pairs))
    return best


def stretches(at: list[int], pairs: list[tuple], need: int, most: int) -> Iterator[tuple[int, int, int]]:
    """(different pairs, first word, word behind the last) of the best stretches with at least `need` different pairs and at most `most` words.

    `at` has the places of the pairs. Of stretches that share a pair the one with the most different pairs is kept, of these the shortest.
    """
    count: Counter = Counter()
    best, low = None, 0
    for place, pair in zip(at, pairs):
        count[pair] += 1
        while place + 2 - at[low] > most or count[pairs[low]] > 1:
            count[pairs[low]] -= 1
            if not count[pairs[low]]:
                del count[pairs[low]]
            low += 1
        if len(count) < need:
            continue
        here = (len(count), at[low], place + 2)
        if best and here[1] >= best[2] - 1:
            yield best
            best = None
        if not best or (here[0], best[2] - best[1]) > (best[0], here[2] - here[1]):
            best = here
    if best:
        yield best


class Classifier:
    """Weights by n-gram and class, and the templates to compare with."""

    def __init__(self, corpus: list[bytes], seed: int = 0) -> None:
        self.classes = [*sorted(TEMPLATES), UNKNOWN]
        notices = [(c, words_of(t.encode())) for c in self.classes[:-1] for t in TEMPLATES[c]]
        self.templates = {c: [pairs_of(w) for k, w in notices if k == c] for c in self.classes[:-1]}
        self.features = {g: k for k, g in enumerate(sorted(set().union(*[grams(w) for _, w in notices])))}
        every = [t for ts in self.templates.values() for t in ts]
        self.notices = [(c, len(t), int(STRETCH * len(w)) + BESIDES) for (c, w), t in zip(notices, every)]
        self.need = np.array([next(n for n in range(len(t) + 1) if n / len(t) >= CONFIRM) for t in every])
        self.within: dict[tuple, list[int]] = {}
        for k, t in enumerate(every):
            for pair in t:
                self.within.setdefault(pair, []).append(k)
        others = [w for w in map(words_of, corpus) if w and similarity(pairs_of(w), every) < 0.3]
        rng = np.random.default_rng(seed)
        filler = sorted({x for w in others[:200] for x in w}) or [b"filler"]
        rows: list[tuple[list[bytes], int]] = []
        for c, words in notices:
            rows += [(v, self.classes.index(c)) for v in variants(words, filler, rng)]
        rows += [(w, len(self.classes) - 1) for w in others]
        rows += [(v, len(self.classes) - 1) for t in TALK for v in variants(words_of(t.encode()), filler, rng)]
        x, y = np.stack([self.row(w) for w, _ in rows]), np.array([c for _, c in rows])
        aside = np.arange(len(y)) % 4 == 3
        self.weights = train(x[~aside], y[~aside], len(self.classes))
        self.weights /= temperature(x[aside] @ self.weights[:-1] + self.weights[-1], y[aside])
        self.index()

    def row(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(self.features), np.float32)
        found = grams(words)
        out[[self.features[g] for g in found if g in self.features]] = scale(len(words))
        return out

    def index(self) -> None:
        """Features by packed word numbers, for whole batches at once. 0 is a word of no template."""
        known = sorted({g[0] for g in self.features if len(g) == 1})
        self.number = {w: k + 1 for k, w in enumerate(known)} | {b"\x00": -1}
        self.base = len(known) + 1
        self.tables = []
        for n in range(1, WORDS + 1):
            some = sorted((self.key([self.number[w] for w in g]), k) for g, k in self.features.items() if len(g) == n)
            self.tables.append((np.array([a for a, _ in some], np.int64), np.array([b for _, b in some], np.int64)))
        lists = [self.within.get(g, []) for g in sorted(self.features, key=self.features.get)]
        self.holders = np.array([len(x) for x in lists])
        self.starts, self.held = np.cumsum(self.holders) - self.holders, np.array([k for x in lists for k in x], np.int64)

    def key(self, numbers: list[int]) -> int:
        out = 0
        for x in numbers:
            out = out * self.base + x
        return out

    def logits(self, ids: np.ndarray, paragraph: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of paragraphs, and which of them have enough pairs of a template for a stretch; ids: word numbers with -1 behind each
        paragraph, paragraph: which one each is in, size: words of each."""
        cells: list = []
        live = np.flatnonzero(ids > 0)
        key = np.zeros(len(live), np.int64)
        for n, (keys, features) in enumerate(self.tables):
            live_ok = live + n < len(ids)
            live, key = live[live_ok], key[live_ok]
            more = ids[live + n]
            live, key = live[more > 0], key[more > 0] * self.base + more[more > 0]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            cells.append(paragraph[live[hit]] * len(self.features) + features[at[hit]])
        cells = np.unique(np.concatenate(cells))  # an n-gram counts once a paragraph
        which, feature = np.divmod(cells, len(self.features))
        out = np.zeros((len(size), len(self.classes)))
        for at in range(0, len(which), 1 << 18):
            some = slice(at, at + (1 << 18))
            first = np.flatnonzero(np.diff(which[some], prepend=-1))
            out[which[some][first]] += np.add.reduceat(self.weights[feature[some]], first, axis=0)
        return out * scale(size)[:, None] + self.weights[-1], self.near(which, feature)

    def near(self, which: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """Paragraphs with enough pairs of a template; which: the paragraph, in order, that holds the feature."""
        out = [np.zeros(0, np.int64)]
        bounds = np.flatnonzero(np.diff(which, prepend=-1))
        bounds = np.append(bounds[np.diff(bounds >> 18, prepend=-1) > 0], len(which))  # whole paragraphs at a time
        for a, b in zip(bounds, bounds[1:]):
            n = self.holders[feature[a:b]]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            template = self.held[np.repeat(self.starts[feature[a:b]], n) + nth]
            cells, pairs = np.unique(np.repeat(which[a:b], n) * len(self.need) + template, return_counts=True)
            out.append(np.unique(cells[pairs >= self.need[cells % len(self.need)]] // len(self.need)))
        return np.concatenate(out)

    def chances(self, words: list[bytes]) -> list[float]:
        """Probabilities of the classes."""
        some = [self.features[g] for g in grams(words) if g in self.features]
        return softmax((self.weights[some].sum(axis=0) * scale(len(words)) + self.weights[-1])[None])[0].tolist()

    def inside(self, words: list[bytes]) -> tuple[dict[str, tuple[float, float]], set[str]]:
        """Probability and similarity of the families that stretches of a paragraph hold, by place; the families of all stretches."""
        places: dict[int, tuple[list, list]] = {}
        for i, pair in enumerate(zip(words, words[1:])):
            for k in self.within.get(pair, ()):
                at, pairs = places.setdefault(k, ([], []))
                at.append(i)
                pairs.append(pair)
        chances: dict[tuple[int, int], list[float]] = {}
        tried, likely = set(), []
        for k, (at, pairs) in sorted(places.items()):
            family, size, most = self.notices[k]
            for both, a, b in stretches(at, pairs, int(self.need[k]), most):
                tried.add(family)
                if (a, b) not in chances:
                    chances[a, b] = self.chances(words[a:b])
                p = chances[a, b][self.classes.index(family)]
                if p >= LIKELY:
                    likely.append((-p * both / size * (both + 1) / (b - a), a, b, family, p, both / size))
        taken, found = [], []
        for _, a, b, *what in sorted(likely):
            k = bisect_left(taken, (a, b))
            if (k == 0 or taken[k - 1][1] <= a) and (k == len(taken) or b <= taken[k][0]):
                taken.insert(k, (a, b))
                found.append((a, *what))
        best: dict[str, tuple[float, float]] = {}
        for _, family, p, same in sorted(found):
            best[family] = max(best.get(family, (0.0, 0.0)), (p, same))
        return best, tried


def scale(words):
    """What an n-gram counts in a paragraph of so many words: long paragraphs need more of them."""
    return 1 / np.sqrt(np.maximum(words, 1))


def variants(words: list[bytes], filler: list[bytes], rng: np.random.Generator) -> Iterator[list[bytes]]:
    yield words
    for k in range(VARIANTS - 1):
        some = [w for w in words if rng.random() > 0.08] or words
        before, after = ([filler[i] for i in rng.integers(0, len(filler), int(rng.integers(0, 6)))] for _ in range(2))
        yield [*before, *some, *after] if k % 2 else some


def train(x: np.ndarray, y: np.ndarray, classes: int, penalty: float = 1e-5, rounds: int = 300, rate: float = 0.3) -> np.ndarray:
    """Weights of the features, then the intercepts, by full-batch gradient steps with running scales."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros((x.shape[1], classes), np.float32)
    mean, square, target = np.zeros_like(w), np.zeros_like(w), np.eye(classes, dtype=np.float32)[y]
    for t in range(1, rounds + 1):
        slope = x.T @ (softmax(x @ w) - target) / len(x) + penalty * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return w.astype(float)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that makes their probabilities fit rows not trained on."""
    grid = 2.0 ** np.arange(-3, 4.01, 0.125)
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


FOUND = "array<struct<paragraph:int,family:string,probability:double,similarity:double>>"


class Scan:
    def __init__(self, classifier) -> None:
        self.classifier = classifier

    def __call__(self, batch: pa.RecordBatch) -> Iterator[dict]:
        it: Classifier = self.classifier.value
        get, parts = it.number.get, []
        for text in batch.column(1):
            words = text.as_py().translate(FOLD).replace(b"\n", b" \x00 ").split()
            ids = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
            parts += [ids, np.array([-1])]
        ids = np.concatenate(parts)
        ends = np.flatnonzero(ids == -1)
        paragraph = np.searchsorted(ends, np.arange(len(ids)), side="left")
        size = np.diff(ends, prepend=-1) - 1
        doc_ends = np.cumsum([len(p) for p in parts])[1::2] - 1
        last = np.searchsorted(ends, doc_ends)
        lines = np.diff(last, prepend=-1)
        z, near = it.logits(ids, paragraph, size)
        best = z.argmax(axis=1)
        found: list[list] = [[] for _ in lines]
        first = np.cumsum(lines) - lines
        near = set(near.tolist())
        maybe = np.union1d(np.flatnonzero((best < len(it.classes) - 1) & (size > 0)), sorted(near)).astype(np.int64)
        owner = np.searchsorted(first, maybe, side="right") - 1
        sure = softmax(z[maybe]).max(axis=1) if len(maybe) else []
        split, at = None, -1
        for p, d, probability in zip(maybe.tolist(), owner.tolist(), sure):
            if d != at:
                split, at = batch.column(1)[d].as_py().split(b"\n"), d
            words, family = words_of(split[p - int(first[d])]), it.classes[best[p]]
            held, tried = it.inside(words) if p in near else ({}, set())
            if family != UNKNOWN and (not held or family in held or family not in tried):
                same = similarity(pairs_of(words), it.templates[family])
                if same >= CONFIRM:
                    held = {family: (float(probability), same)} | {k: v for k, v in held.items() if k != family}
            for family, (probability, same) in held.items():
                found[d].append({"paragraph": p - int(first[d]), "family": family, "probability": probability, "similarity": same})
        some = np.add.reduceat((size > 0).astype(np.int64), first) if len(first) else []
        yield {"id": batch.column(0), "n_paragraphs": some, "found": found}


def fit(docs: DataFrame, text_col: str = "text") -> Classifier:
    """Trains on at most PARAGRAPHS different lines (of at most LENGTH bytes) of the documents, those with the smallest hash."""
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line"))
    short = lines.where((F.octet_length("line") <= LENGTH) & (F.length(F.trim("line")) > 0))
    some = hash_sample(short, PARAGRAPHS).collect()
    return Classifier([r["line"].encode() for r in some])


def scan(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_paragraphs, found (paragraph counted in lines from 0, family, probability, similarity; several
    families of a paragraph in turn)."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)  # a few hundred kilobytes whatever the corpus
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t"))
    return over_batches(given, Scan(shared), f"id {kind}, n_paragraphs long, found {FOUND}")

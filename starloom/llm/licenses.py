"""License scan: which paragraphs state a licence, and of which family.

Sparse word n-grams (1 to 3) of a paragraph go through a softmax regression over licence
families and ``none``.  It is trained on variations of the families' templates and on a
bounded sample of the corpus's own paragraphs.  Probabilities are tempered on held-out
rows; below the level that keeps held-out ``none`` rows out, the family is ``unknown``.  A
prediction is confirmed by comparing the paragraph with the family's templates.  A notice
wrapped over lines is compared as a whole: lines that follow each other and stand in one
template are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import textops as t
from starloom.llm.linear import gram_hashes

#: Sentences by which public licences are stated.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Distributed under the terms of the Apache License 2.0.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
    ],
    "cc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Licensed under the MIT License.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "reserved": ["All rights reserved.", "Copyright. All rights reserved."],
}
NONE, UNKNOWN = "none", "unknown"

#: ``none`` is learned from at most so many paragraphs, those with the smallest hashes.
SAMPLE_PARAGRAPHS = 4000
COPIES = 60
BITS = 15
GRAMS = 3
CONFIRM = 0.6
#: Share of a line's word pairs that a template must have for the line to be a piece of it.
PIECE = 0.5


def paragraphs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word: row, number in the row, and the word hashes with their offsets.

    Punctuation around words and case do not count.
    """
    data, offsets = t.utf8(column)
    folded = _FOLD[data]
    # A line is a text of its own.
    breaks = np.flatnonzero(data == 10) + 1
    bounds = np.union1d(offsets, breaks)
    hashes, counts = t.word_hashes(folded, bounds)
    row = np.searchsorted(offsets, bounds[:-1], side="right") - 1
    start = np.searchsorted(bounds, offsets[row], side="left")
    number = np.arange(len(row)) - start
    ends = np.cumsum(counts)
    keep = counts > 0
    at = np.concatenate(([0], ends))
    return row[keep], number[keep], hashes, np.stack([at[:-1][keep], at[1:][keep]], 1)


_FOLD = t.LOWER.copy()
_FOLD[list(b".,;:!?()[]{}\"'*_/")] = 32


def features(words: np.ndarray) -> np.ndarray:
    grams = [gram_hashes(words, size) for size in range(1, GRAMS + 1)]
    return np.unique(np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Families:
    names: list[str]
    weights: np.ndarray
    temperature: float
    unknown_below: float
    templates: dict[str, list[np.ndarray]]

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        scores = np.stack([self.weights[r].sum(axis=0) / max(len(r), 1) ** 0.5 for r in rows])
        return _softmax((scores + self.weights[-1]) / self.temperature)

    def similarity(self, words: np.ndarray, family: str) -> float:
        """Share of a template's word pairs that the paragraph has, best of the family's."""
        own = np.unique(gram_hashes(words, 2))
        shares = [np.isin(p, own).mean() for p in self.templates.get(family, []) if len(p)]
        return float(max(shares, default=0.0))


    def wrapped(
        self, row: np.ndarray, number: np.ndarray, hashes: np.ndarray, spans: np.ndarray
    ) -> dict[int, tuple[str, float, float]]:
        """Family, probability and similarity of lines that state a licence together with
        the lines next to them."""
        every = np.unique(np.concatenate([p for known in self.templates.values() for p in known]))
        if len(spans) < 2:
            return {}
        hits = np.concatenate(([0], np.cumsum(np.isin(gram_hashes(hashes, 2), every)), [0]))
        hits[-1] = hits[-2]
        a, b = spans[:, 0], spans[:, 1]
        near = hits[np.maximum(b - 1, a)] - hits[a] >= PIECE * (b - 1 - a)
        after = np.flatnonzero(near[1:] & near[:-1] & (row[1:] == row[:-1]) & (number[1:] == number[:-1] + 1)) + 1
        found: dict[int, tuple[str, float, float]] = {}
        for group in np.split(after, np.flatnonzero(np.diff(after) > 1) + 1) if len(after) else []:
            lines = range(int(group[0]) - 1, int(group[-1]) + 1)
            for family, known in self.templates.items():
                for pairs in known:
                    self._join(lines, family, pairs, hashes, spans, found)
        return found

    def _join(self, lines, family, pairs, hashes, spans, found) -> None:
        """Puts into ``found`` the lines, of neighbouring ones, that state one template."""
        run: list[int] = []
        for k in [*lines, None]:
            if k is not None:
                own = gram_hashes(hashes[spans[k, 0] : spans[k, 1]], 2)
                hit = np.isin(own, pairs)
                # A line that states the template alone needs no neighbours.
                alone = len(own) and np.isin(pairs, own).mean() >= CONFIRM
                if not alone and (not len(own) or hit.mean() >= PIECE):
                    run.append(k)
                    continue
            if len(run) > 1:
                # Lines at either end that add nothing to the template are not of it.
                base = spans[run[0], 0]
                grams = gram_hashes(hashes[base : spans[run[-1], 1]], 2)
                at = np.flatnonzero(np.isin(grams, pairs))
                values, left = grams[at].tolist(), Counter(grams[at].tolist())
                share = len(left) / max(len(pairs), 1)
                i, j, first, last = 0, len(at), 0, len(run) - 1
                while first < last:
                    end = i
                    while end < j and at[end] < spans[run[first], 1] - base:
                        end += 1
                    if any(left[v] <= n for v, n in Counter(values[i:end]).items()):
                        break
                    left.subtract(values[i:end])
                    i, first = end, first + 1
                while first < last:
                    begin = j
                    while begin > i and at[begin - 1] + 1 >= spans[run[last], 0] - base:
                        begin -= 1
                    if any(left[v] <= n for v, n in Counter(values[begin:j]).items()):
                        break
                    left.subtract(values[begin:j])
                    j, last = begin, last - 1
                if last > first and share >= CONFIRM:
                    words = hashes[spans[run[first], 0] : spans[run[last], 1]]
                    sure = float(self.probabilities([features(words)])[0, self.names.index(family)])
                    for line in run[first : last + 1]:
                        if share > found.get(line, ("", 0.0, 0.0))[2]:
                            found[line] = family, sure, share
            run = []


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _words(text: str) -> np.ndarray:
    return paragraphs(pa.array([text.replace("\n", " ")]))[2]


def _variations(random: np.random.Generator, words: np.ndarray, filler: np.ndarray) -> np.ndarray:
    """A template with a few words lost and other words around it."""
    kept = words[random.random(len(words)) > random.choice([0.0, 0.05, 0.1])]
    around = [random.choice(filler, random.integers(0, 6)) if len(filler) else filler for _ in range(2)]
    return np.concatenate((around[0], kept, around[1]))


def fit(negative: list[np.ndarray], seed: int = 3, steps: int = 200) -> Families:
    """``negative``: word hashes of corpus paragraphs.  Those that are close to a template
    are not ``none`` and are left out."""
    random = np.random.default_rng(seed)
    names = [*sorted(TEMPLATES), NONE]
    words = {f: [_words(x) for x in TEMPLATES[f]] for f in TEMPLATES}
    pairs = {f: [np.unique(gram_hashes(w, 2)) for w in words[f]] for f in TEMPLATES}
    model = Families(names, np.zeros((1, 1)), 1.0, 0.5, pairs)
    negative = [n for n in negative if max(model.similarity(n, f) for f in TEMPLATES) < 0.5]
    filler = np.concatenate(negative[:200]) if negative else np.zeros(0, np.uint64)
    rows, labels = [], []
    for k, family in enumerate(names[:-1]):
        for _ in range(COPIES):
            for w in words[family]:
                rows.append(features(_variations(random, w, filler)))
                labels.append(k)
    rows += [features(n) for n in negative]
    labels += [len(names) - 1] * len(negative)
    y, size = np.array(labels), 1 << BITS
    held = random.random(len(y)) < 0.2
    importance = 1 / np.bincount(y, minlength=len(names))[y]
    lengths = np.array([len(r) for r in rows])
    index, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), lengths)
    values = np.repeat(1 / np.sqrt(np.maximum(lengths, 1)), lengths)
    weights, squares = np.zeros((size + 1, len(names))), np.full((size + 1, len(names)), 1e-8)
    truth = np.eye(len(names))[y]

    def scores() -> np.ndarray:
        columns = [np.bincount(owner, weights[index, k] * values, len(rows)) for k in range(len(names))]
        return np.stack(columns, 1) + weights[-1]

    for _ in range(steps):
        error = (_softmax(scores()) - truth) * (importance * ~held)[:, None]
        slope = np.zeros_like(weights)
        for k in range(len(names)):
            slope[:-1, k] = np.bincount(index, error[owner, k] * values, size)
        slope[-1] = error.sum(axis=0)
        squares += slope**2
        weights -= 0.3 * slope / np.sqrt(squares)
    found = scores()[held]
    losses = {
        temperature: -np.log(np.maximum(_softmax(found / temperature)[np.arange(held.sum()), y[held]], 1e-12)).mean()
        for temperature in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
    }
    model.temperature = min(losses, key=losses.get) if held.any() else 1.0
    model.weights = weights.astype(np.float32)
    none = _softmax(found / model.temperature)[y[held] == len(names) - 1, :-1]
    model.unknown_below = float(np.clip(np.quantile(none.max(axis=1), 0.999) if len(none) else 0.5, 0.5, 0.95))
    return model


def train(documents: DataFrame, text: str = "text", sample: int = SAMPLE_PARAGRAPHS) -> Families:
    """A model with this corpus's paragraphs as ``none``."""
    lines = documents.select(F.explode(F.split(F.col(f"`{text}`"), "\n")).alias("line")).filter(
        F.col("line").rlike(r"[^\x20\x09-\x0D]")
    )
    # The sample is bounded in rows; its lines are whole.
    hashed = lines.select("line", F.xxhash64("line").alias("h"))
    # Distinct lines, found by their hashes first: no shuffle carries all texts.
    least = hashed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    picked = hashed.filter(F.col("h") <= F.lit(least).cast("bigint")).distinct().orderBy("h", "line").limit(sample)
    return fit([_words(r["line"]) for r in picked.collect()])


def scan(documents: DataFrame, model: Families, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per paragraph that the classifier takes for a licence's: document, paragraph
    number (from 0), family (``unknown`` below the calibrated level), probability, template
    similarity and whether the templates confirm the family.

    Null and blank texts have no paragraphs.  Null and repeated keys are kept.
    """
    kind = documents.schema[key].dataType.simpleString()
    columns = "paragraph bigint, family string, probability double, similarity double, confirmed boolean"
    names = [key, *[c.split()[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = t.utf8(batch.column(1))
            out: list[tuple] = []
            for i, j in t.row_blocks(offsets):
                row, number, hashes, spans = paragraphs(batch.column(1).slice(i, j - i))
                words = [hashes[a:b] for a, b in spans.tolist()]
                joined = model.wrapped(row, number, hashes, spans)
                for at in range(0, len(words), 2000):
                    part = words[at : at + 2000]
                    p = model.probabilities([features(w) for w in part])
                    best = np.argmax(p[:, :-1], axis=1)
                    stated = p[:, -1] < 0.5
                    stated[[k - at for k in joined if at <= k < at + len(part)]] = True
                    for k in np.flatnonzero(stated):
                        family, sure = model.names[best[k]], float(p[k, best[k]])
                        alike = model.similarity(part[k], family)
                        if alike < CONFIRM and at + k in joined:
                            family, sure, alike = joined[at + k]
                        known = sure >= model.unknown_below
                        out.append(
                            (i + int(row[at + k]), int(number[at + k]), family if known else UNKNOWN,
                             sure, alike, known and alike >= CONFIRM)
                        )
            rows = list(zip(*out)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())),
                 *[pa.array(c, k) for c, k in zip(rows[1:], kinds)]], names,
            )

    given = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(run, f"`{key}` {kind}, {columns}")

"""Licence notices in documents: lines, whole texts and runs of words against templates, by Dice over word bigrams.

A text is lower-cased (A-Z) and everything but letters and digits of ASCII becomes one space. Every line, and
the whole text if it has several, is a passage. The Dice coefficient of two sets of bigrams is twice what
they share by the sum of their sizes, so it can reach ``LEAST`` only where the sizes are within a factor of
each other: templates of other sizes are never compared.

Notices that are wrapped over lines or stand amid other words are runs of words, line breaks or not. They are
also compared with the full wordings. Only runs that begin and end with a bigram of the template, and have their
first bigram once, are tried: any other run scores no more than such a run inside it. Of runs that overlap the one
that shares most bigrams with its template counts, and it counts only if it shares more than any matching
passage it overlaps, which it then replaces. Otherwise the passage stands for it.

Defined cases: a null or empty text matches nothing; passages of less than two words match nothing; equal
scores go to the earlier passage, then to the template named first; repeated rows are scanned alike; an
empty table gives no rows; columns other than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .license_texts import FULL
from .shared import fields, need_columns

#: Score from which a passage counts as a notice, in percent.
LEAST = 75

#: Licence notices (fixed values): the name and the wording, one or several per licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
]

_LOWER = {c: c + 32 for c in range(65, 91)}
_OTHER = re.compile("[^a-z0-9]+")


def normalised(text: str) -> list[str]:
    return _OTHER.sub(" ", text.translate(_LOWER)).split()


def bigrams(words: list[str]) -> frozenset[tuple[str, str]]:
    return frozenset(zip(words, words[1:], strict=False))


class Scanner:
    """Templates by the number of their bigrams."""

    def __init__(self, templates: list[tuple[str, str]], least: int = LEAST):
        self.least = least
        ranked = sorted((len(g), i, name, g) for i, (name, text) in enumerate(templates) if (g := bigrams(normalised(text))))
        self.ranked, self.sizes = ranked, [r[0] for r in ranked]
        self.by_place = {i: g for _, i, _, g in ranked}

    def candidates(self, size: int) -> list[tuple]:
        """Templates whose size leaves the least score possible."""
        low = size * self.least / (200 - self.least)
        high = size * (200 - self.least) / self.least
        return self.ranked[bisect_left(self.sizes, low) : bisect_right(self.sizes, high)]

    def best(self, words: list[str]) -> tuple[float, int, str] | None:
        """(score, place of the template, its name) of the best match of a passage, if it is good enough."""
        # A passage of n words has n - 1 bigrams or fewer: too few words can't match.
        if len(words) < 2 or len(words) - 1 < self.sizes[0] * self.least / (200 - self.least):
            return None
        scores = self.scores(bigrams(words))
        return max(scores) if scores else None

    def scores(self, own: frozenset[tuple[str, str]]) -> list[tuple[float, int, str]]:
        return [(2 * len(own & g) / (len(own) + n), -i, name) for n, i, name, g in self.candidates(len(own)) if 200 * len(own & g) >= self.least * (len(own) + n)]


class Runs:
    """Runs of words that match a template."""

    def __init__(self, templates: list[tuple[str, str]], least: int = LEAST):
        self.least = least
        self.templates = [(i, name, g) for i, (name, text) in enumerate(templates) if (g := bigrams(normalised(text)))]
        self.of: dict[tuple[str, str], list[int]] = {}
        for k, (_, _, g) in enumerate(self.templates):
            for b in g:
                self.of.setdefault(b, []).append(k)

    def within_reach(self, own: frozenset[tuple[str, str]]) -> list[int]:
        """Templates of which a text with these bigrams has enough for a match: a run that has no others at all."""
        shared = [0] * len(self.templates)
        for b in own & self.of.keys():
            for k in self.of[b]:
                shared[k] += 1
        return [k for k, n in enumerate(shared) if n and 200 * n >= self.least * (n + len(self.templates[k][2]))]

    def candidates(self, grams: list[tuple[str, str]], near: list[int], low: int, high: int) -> list[tuple]:
        """(bigrams shared, score, first, last, template) of the best run from each start among bigrams ``low`` to ``high``."""
        place: dict[tuple[str, str], int] = {}
        before = np.empty(high - low, np.int64)
        after = np.full(high - low, high - low, np.int64)
        for at in range(high - low):
            seen = place.get(grams[low + at], -1)
            before[at] = seen
            if seen >= 0:
                after[seen] = at
            place[grams[low + at]] = at
        out = []
        for k in near:
            g = self.templates[k][2]
            n, most = len(g), len(g) * (200 - self.least) // self.least
            hit = np.fromiter((b in g for b in grams[low:high]), bool, high - low)
            if len(place.keys() & g) * (200 - self.least) < self.least * n:
                continue
            for start in np.flatnonzero(hit).tolist():
                # Up to where the first bigram comes again, or there are too many others.
                at, own, shared, top = start, 0, 0, None
                while at < after[start] and own <= most:
                    end = min(at + 2 * most + 2, int(after[start]))
                    new = before[at:end] < start
                    owns, shares = own + np.cumsum(new), shared + np.cumsum(new & hit[at:end])
                    ok = np.flatnonzero(new & hit[at:end] & (200 * shares >= self.least * (owns + n)))
                    if len(ok):
                        # The last one shares most: each end adds a bigram.
                        c, o = int(shares[ok[-1]]), int(owns[ok[-1]])
                        top = (c, 2 * c / (o + n), low + start, low + at + int(ok[-1]), k)
                    at, own, shared = end, int(owns[-1]), int(shares[-1])
                if top:
                    out.append(top)
        return out

    def found(self, words: list[str], own: frozenset[tuple[str, str]], passages: list[tuple[int, int, int]]) -> list[tuple]:
        """Runs that don't overlap and share more than the ``passages`` (bigrams shared, first, last) they overlap."""
        near = self.within_reach(own)
        if not near:
            return []
        grams = list(zip(words, words[1:], strict=False))
        out, open_parts = [], [(0, len(grams))]
        while open_parts:
            low, high = open_parts.pop()
            taken: list[tuple] = []
            for run in sorted(self.candidates(grams, near, low, high), key=lambda r: (-r[0], -r[1], r[2], r[4])):
                at = bisect_left(taken, run[2], key=lambda r: r[3])
                # Ends are in order as runs don't overlap: this is the first that ends at the run's start or later.
                if at == len(taken) or taken[at][2] > run[3]:
                    taken.insert(at, run)
            # What lies between runs may hold another one.
            edges = [low, *(x for r in taken for x in (r[2], r[3] + 1)), high]
            if taken:
                open_parts += [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]
            out += taken
        return [r for r in out if all(r[0] > c for c, first, last in passages if first <= r[3] and r[2] <= last)]


def notices(text: str | None, scanner: Scanner, runs: Runs) -> list[tuple[float, int, int, str, int]]:
    """Matches of a text: score, rank of the passage (greater is earlier), minus the template's place, its name, and the passage."""
    lines = [normalised(line) if line else [] for line in (text or "").split("\n")]
    words = [w for line in lines for w in line]
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(line))
    hits = [(place, hit) for place, p in [*enumerate(lines, 1), *([(0, words)] if len(lines) > 1 else [])] if (hit := scanner.best(p))]
    own = bigrams(words)
    spans = []
    for place, _ in hits:
        first, last = (starts[place - 1], starts[place]) if place else (0, len(words))
        grams = list(zip(words[first:last], words[first + 1 : last], strict=False))
        for _, minus, _ in scanner.scores(frozenset(grams)):
            g = scanner.by_place[-minus]
            at = [i for i, b in enumerate(grams) if b in g]
            spans.append((len({grams[i] for i in at}), first + at[0], first + at[-1], place))
    more = runs.found(words, own, [s[:3] for s in spans])
    covered = {place for _, first, last, place in spans if any(first <= r[3] and r[2] <= last for r in more)}
    out = [(hit[0], -(place or len(lines) + 1), hit[1], hit[2], place) for place, hit in hits if place not in covered]
    for _, score, first, _, k in more:
        i, name, _ = runs.templates[k]
        place = bisect_right(starts, first)
        out.append((score, -place, -i, name, place))
    return out


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: int = LEAST, full: list[tuple[str, str]] = FULL) -> DataFrame:
    """Per row: ``doc_id``, ``n_notices`` (passages and runs that match), and of the best one its ``license``, ``dice`` and ``passage`` (line from 1, of a run the one it begins in; 0: the text).

    ``notices`` lists all of them as (license, dice, passage), in the order of the text, the whole text last.
    """
    docs = need_columns(docs, ["doc_id", "text"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, runs = Scanner(templates, least), Runs([*templates, *full], least)
        for batch in batches:
            counts, names, dices, places, every = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                hits = notices(text, scanner, runs)
                top = max(hits, default=None)
                counts.append(len(hits))
                names.append(top and top[3])
                dices.append(top and top[0])
                places.append(top and top[4])
                every.append([{"license": h[3], "dice": h[0], "passage": h[4]} for h in sorted(hits, key=lambda h: (h[4] == 0, h[4], h[3], -h[0]))])
            columns = {"doc_id": batch.column(0), "n_notices": pa.array(counts, pa.int64()), "license": pa.array(names, pa.string()), "dice": pa.array(dices, pa.float64()), "passage": pa.array(places, pa.int64())}
            yield pa.record_batch(columns | {"notices": pa.array(every, pa.list_(pa.struct({"license": pa.string(), "dice": pa.float64(), "passage": pa.int64()})))})

    return docs.mapInArrow(look, fields(doc_id=dict(docs.dtypes)["doc_id"], n_notices="long", license="string", dice="double", passage="long", notices="array<struct<license:string,dice:double,passage:bigint>>"))

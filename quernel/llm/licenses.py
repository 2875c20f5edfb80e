"""License scan: Dice coefficient over word bigrams against license templates.

Lines and paragraphs are normalised (A-Z in lower case, everything but letters
and digits a blank) and compared with every template that can reach the bound:
with a and b bigrams the coefficient is at most 2 * min(a, b) / (a + b), so
templates, sorted by size, are cut to a range by bisection, mostly an empty one.

A notice inside other text, or over several paragraphs, is neither: a window of
each template's size also slides over the words of the whole text. A text is left
out only if it has none of the template's anchors, rare bigrams so many that no
match can lack them all, or altogether too few of its bigrams.

Licenses share sentences, so each place gets the best template only: one per line and paragraph,
and of windows that share more than half of the longer one's words the one with the largest coefficient.
Work is linear in the text for each template, but for the sort of its windows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from importlib.resources import files
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quernel.llm.common import whole

BOUND = 0.8

# The notices that the licenses themselves ask for, or their first lines, and complete grants.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "MIT": "Released under the MIT License.",
    "MIT-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0-work": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-title": "The MIT License (MIT)",
}

#: The full texts, each in a file of its own. They have blank lines inside, so mostly windows find them.
TEXTS = "Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-1.0 GPL-1.0 GPL-2.0 GPL-3.0 ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 MIT MPL-1.1 MPL-2.0 Unlicense".split()
FULL_TEXTS = {f"{name}-text": (files(__package__) / "license_texts" / f"{name}.txt").read_text("utf-8") for name in TEXTS}

#: A paragraph ends at a blank line.
PARAGRAPH = rb"\n[\x20\x09-\x0D]*\n"

_TABLE = bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def bigrams(text: bytes) -> list[tuple[bytes, bytes]]:
    words = text.translate(_TABLE).split()
    return list(zip(words, words[1:]))


def _line_starts(text: bytes) -> list[int]:
    """The number of words before each line, and of all."""
    return [0, *accumulate(len(line.translate(_TABLE).split()) for line in text.split(b"\n"))]


def _lines(starts: list[int], at: int, stop: int) -> tuple[int, int]:
    """(first line, number of lines) of these words."""
    first = bisect_right(starts, at) - 1
    return first, bisect_left(starts, stop) - first


class _Spans:
    """Disjoint spans of words in order; what meets one that is there is merged with it."""

    def __init__(self):
        self.starts: list[int] = []
        self.stops: list[int] = []
        self.dice: list[float] = []

    def _range(self, at: int, stop: int) -> tuple[int, int]:
        return bisect_right(self.stops, at), bisect_left(self.starts, stop)

    def meets(self, at: int, stop: int) -> bool:
        first, last = self._range(at, stop)
        return first < last

    def add(self, at: int, stop: int, dice: float = 1.0) -> None:
        first, last = self._range(at, stop)
        if first < last:
            at, stop = min(at, self.starts[first]), max(stop, self.stops[last - 1])
            dice = max(dice, *self.dice[first:last])
        self.starts[first:last], self.stops[first:last], self.dice[first:last] = [at], [stop], [dice]

    def same_place(self, at: int, stop: int, dice: float) -> bool:
        """Whether a span with at least this coefficient shares more than half of the longer one's words."""
        first, last = self._range(at, stop)
        return any(
            self.dice[i] >= dice
            and 2 * (min(stop, self.stops[i]) - max(at, self.starts[i])) > max(stop - at, self.stops[i] - self.starts[i])
            for i in range(first, last)
        )


class Matcher:
    """Templates in order of their number of bigrams."""

    def __init__(self, templates: dict[str, str], bound: float):
        made = [(len(b), name, Counter(b)) for name, text in templates.items() if (b := bigrams(text.encode()))]
        self.templates = sorted(made, key=lambda x: x[:2])
        self.sizes = [n for n, _, _ in self.templates]
        self.size_of = {name: n for n, name, _ in self.templates}
        self.bound, self.ratio = bound, bound / (2 - bound)
        self.known = {pair for _, _, template in self.templates for pair in template}
        #: Bigram to the templates that it is an anchor of.
        self.anchors: dict[tuple[bytes, bytes], list[int]] = {}
        for k, (size, _, template) in enumerate(self.templates):
            # A match shares at least size * ratio bigrams, so it lacks at most the rest. Long words are rare.
            lacking = size - size * self.ratio + 1e-6
            for pair in sorted(template, key=lambda x: (-len(x[0]) - len(x[1]), x)):
                self.anchors.setdefault(pair, []).append(k)
                lacking -= template[pair]
                if lacking < 0:
                    break

    def compare(self, text: bytes):
        """(license, dice) of every template that reaches the bound."""
        pairs = bigrams(text)
        n = len(pairs)
        # Bounds with room for rounding; the coefficient itself decides.
        first = bisect_left(self.sizes, n * self.ratio - 1e-6)
        last = bisect_right(self.sizes, n / self.ratio + 1e-6)
        if first >= last or not n:
            return
        known = [pair for pair in pairs if pair in self.known]
        if 2 * len(known) < self.bound * (n + self.sizes[first]) - 1e-6:
            return
        have = Counter(known)
        for size, name, template in self.templates[first:last]:
            dice = 2 * (have & template).total() / (n + size)
            if dice >= self.bound:
                yield name, dice

    def segments(self, text: bytes):
        """(first line, number of lines, bytes) of each line, and of each paragraph of several lines."""
        for i, line in enumerate(text.split(b"\n")):
            yield i, 1, line
        at = line = 0
        for match in [*re.finditer(PARAGRAPH, text), None]:
            stop = match.start() if match else len(text)
            inside = text.count(b"\n", at, stop)
            if inside:
                yield line, inside + 1, text[at:stop]
            if match:
                line += inside + match[0].count(b"\n")
                at = match.end()

    def best(self, text: bytes):
        """The (license, dice) of a line or paragraph: the largest coefficient, then the longest template."""
        found = sorted(self.compare(text), key=lambda x: (-x[1], -self.size_of[x[0]], x[0]))
        return found[:1]

    def matches(self, text: bytes):
        """(license, dice, first line, number of lines) of lines and paragraphs, then of windows.

        A window is left out if a window chosen before it, or a line or paragraph with no smaller
        coefficient, has the same place. Windows are chosen by coefficient, then the longest template, then
        place. One that meets a line or paragraph of the same license is not reported again.
        """
        found = [(name, dice, i, n) for i, n, part in self.segments(text) for name, dice in self.best(part)]
        placed = list(self.placed_windows(text))
        if not placed:
            return found
        starts = _line_starts(text)
        taken: dict[str, _Spans] = {}
        known: dict[str, _Spans] = {}
        for name, dice, i, n in sorted(found, key=lambda x: (x[2], x[3])):
            known.setdefault(name, _Spans()).add(starts[i], starts[i + n])
            taken.setdefault("paragraphs" if n > 1 else "lines", _Spans()).add(starts[i], starts[i + n], dice)
        chosen = []
        for name, dice, at, stop in sorted(placed, key=lambda x: (-x[1], -self.size_of[x[0]], x[2], x[0])):
            if any(spans.same_place(at, stop, dice) for spans in taken.values()):
                continue
            taken.setdefault(f"windows of {name}", _Spans()).add(at, stop, dice)
            if not (name in known and known[name].meets(at, stop)):
                chosen.append((name, dice, *_lines(starts, at, stop)))
        return [*found, *chosen]

    def windows(self, text: bytes):
        """(license, dice, first line, number of lines) of ``placed_windows``."""
        starts = _line_starts(text)
        for name, dice, at, stop in self.placed_windows(text):
            yield name, dice, *_lines(starts, at, stop)

    def placed_windows(self, text: bytes):
        """(license, dice, first word, end) of the best windows of the whole text, for each template.

        A window has the template's number of bigrams, or all of a shorter text. The best comes first, of equal
        ones the first in the text, then the best of those without a word in common with it, and so on.
        """
        words = text.translate(_TABLE).split()
        if self.anchors.keys().isdisjoint(zip(words, words[1:])):
            return
        pairs = list(zip(words, words[1:]))
        known, n = [pair for pair in pairs if pair in self.known], len(pairs)
        least = [self.bound * (min(n, size) + size) / 2 - 1e-6 for size in self.sizes]
        near = {k for pair in self.anchors.keys() & set(known) for k in self.anchors[pair] if len(known) >= least[k]}
        if not near:
            return
        have = Counter(known)
        for k in sorted(near):
            size, name, template = self.templates[k]
            if (have & template).total() < least[k]:
                continue
            taken = _Spans()
            best = sorted((-dice, at) for at, dice in self.slide(pairs, size, template))
            for dice, at in best:
                stop = at + min(n, size) + 1
                if not taken.meets(at, stop):
                    taken.add(at, stop)
                    yield name, -dice, at, stop

    def slide(self, pairs, size: int, template: Counter):
        """(place, dice) of the windows that reach the bound."""
        width = min(len(pairs), size)
        seen, shared = Counter(), 0
        for i, pair in enumerate(pairs):
            want = template.get(pair, 0)
            if want:
                seen[pair] += 1
                shared += seen[pair] <= want
            if i >= width and (want := template.get(old := pairs[i - width], 0)):
                shared -= seen[old] <= want
                seen[old] -= 1
            if i >= width - 1 and (dice := 2 * shared / (width + size)) >= self.bound:
                yield i - width + 1, dice


_FOUND = T.StructType(
    [T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()),
     T.StructField("first_line", T.LongType()), T.StructField("n_lines", T.LongType())]
)
_ARROW = pa.list_(
    pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int64()), ("n_lines", pa.int64())])
)


def scan(docs: DataFrame, templates=TEMPLATES | FULL_TEXTS, bound: float = BOUND) -> DataFrame:
    """(doc_id, matches), a row per document; a match has license, dice, first_line and n_lines.

    Windows of the whole text come after lines and paragraphs, and only where these do not have the same
    license already. A place has its best license only. A null or blank text has none, a very long one is
    scanned as a whole. Repeated lines are all reported. Rows with the same id are
    scanned one by one. An empty table gives an empty table.
    """

    def run(batches):
        matcher = Matcher(templates, bound)
        for batch in batches:
            found = [
                [
                    {"license": name, "dice": dice, "first_line": first, "n_lines": n}
                    for name, dice, first, n in matcher.matches(text)
                ]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW)], ["doc_id", "matches"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("matches", T.ArrayType(_FOUND))])
    return docs.select("doc_id", whole().cast("binary").alias("text")).mapInArrow(run, schema)

"""License scans by patience alignment of texts with license templates.

A text and a template are aligned over their words (lower-cased letters and digits). Words
that occur once on either side are anchors; the longest increasing subsequence of their
places is kept, runs of equal words around each anchor are added, and the gaps between are
aligned the same way, where more words have become unique; a gap without a unique common word
is aligned by its longest common subsequence. Coverage is the share of template words aligned.

A text may hold a template anywhere and several times, so the stretches to align are looked for
first: the text's words are read once for chains of template words in template order. A chain
gains 1 a word and loses ``SKIP`` for each template word and ``INSERT`` for each other word that
it passes over, so words may be inserted anywhere, but a stretch must be dense: words strewn over
a long text are no chain. A chain that could cover enough is aligned as above, stretch against
template; the alignment alone decides whether it is a hit, its coverage and its bounds. Words of
the stretch that the template doesn't have can't be aligned and are left out of that. Of
overlapping chains the best counts. No step has a grid, so a hit doesn't depend on where in the
text it starts.

Defined results: null and empty texts have no hits; a null ``doc_id`` and repeated rows have
their hits each; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import text_rows

MIN_COVERAGE = 0.8
SKIP, INSERT = 0.25, 0.125

# Notices and grants as their publishers word them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions: The above copyright notice and this permission notice shall be included in all "
           "copies or substantial portions of the Software.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met: Redistributions of source code must retain the "
                    "above copyright notice, this list of conditions and the following disclaimer. Redistributions "
                    "in binary form must reproduce the above copyright notice, this list of conditions and the "
                    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                  "in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, "
               "or (at your option) any later version.",
}

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    ends: list[int] = []
    places: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(ends, v)
        before[i] = places[k - 1] if k else -1
        if k == len(ends):
            ends.append(v)
            places.append(i)
        else:
            ends[k], places[k] = v, i
    out, i = [], places[-1] if places else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, for gaps in which no word is unique."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i][j] = 1 + table[i + 1][j + 1] if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), ascending on both sides."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:      # equal words at the edges of the gap
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once_a = Counter(a[a0:a1])
        once_b = Counter(b[b0:b1])
        at = {w: i for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1}
        anchors = [(at[w], j) for j, w in enumerate(b[b0:b1], b0) if once_b[w] == 1 and w in at]
        last_a, last_b = a0, b0
        for k in increasing([i for i, _ in anchors]):
            i, j = anchors[k]
            out.append((i, j))
            todo.append((last_a, i, last_b, j))
            last_a, last_b = i + 1, j + 1
        if last_a > a0:
            todo.append((last_a, a1, last_b, b1))
        else:
            out += [(a0 + i, b0 + j) for i, j in common(a[a0:a1], b[b0:b1])]
    return sorted(out)


def density(matched: int, stretch: int) -> float:
    """What ``matched`` words are worth in a stretch of so many words; a hit's must be positive."""
    return matched - INSERT * (stretch - matched)


def chains(at: list[tuple[int, ...]], places: list[int], size: int, need: float) -> Iterator[tuple[int, int, int]]:
    """(first, last, words matched) of disjoint chains of ``need`` words at least, ascending.

    ``at``: for each word that the template has, in text order, its places in the template of
    ``size`` words, descending; ``places``: its place in the text.
    """
    reach = size + int(size / SKIP)          # no chain of a positive score passes over more of these
    cost = [SKIP * p + INSERT * (place - p) for p, place in enumerate(places)]
    lo = 0
    while True:
        # best chain that ends at each template place or before: (score as of cost 0, first, matched)
        row = [(-float("inf"), 0, 0)] * size
        best, done = None, False
        for p in range(lo, len(at)):
            for j in at[p]:
                score, first, matched = 1.0, p, 1
                if j and (had := row[j - 1][0] - cost[p] + SKIP) > 0:
                    score, first, matched = had + 1, row[j - 1][1], row[j - 1][2] + 1
                entry = (score + cost[p], first, matched)
                for i in range(j, size):
                    if row[i] >= entry:
                        break
                    row[i] = entry
                if matched >= need:
                    if best and first > best[2]:
                        done = True
                    elif not best or score > best[0]:
                        best = score, first, p, matched
            if best and (done or best[3] == size or p - best[2] > reach):
                break
        if not best:
            return
        yield best[1:]
        lo = best[2] + 1


class Scanner:
    def __init__(self, templates: dict[str, str], min_coverage: float):
        self.min_coverage = min_coverage
        self.templates = []
        for name, text in templates.items():
            if t := words(text):
                at = {w: tuple(j for j in reversed(range(len(t))) if t[j] == w) for w in t}
                self.templates.append((name, t, at, Counter(t)))
        self.vocabulary = frozenset(w for _, t, _, _ in self.templates for w in t)

    def _hits(self, held: list[str], places: list[int], t: list[str], at: dict, need: float
              ) -> Iterator[tuple[int, int, int]]:
        """(first word, last word, words aligned) of each hit; ``held``: the template words of the text."""
        lo = 0
        for first, last, _ in chains([at[x] for x in held], places, len(t), need):
            if first - lo >= need:                    # a chain that lost to this one may stand without its end
                yield from self._hits(held[lo:first], places[lo:first], t, at, need)
            lo = last + 1
            found = align(held[first:last + 1], t)
            if len(found) >= need:
                a, b = places[first + found[0][0]], places[first + found[-1][0]]
                if density(len(found), b + 1 - a) > 0:
                    yield a, b, len(found)

    def __call__(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, end word) of each hit."""
        w = words(text)
        present = self.vocabulary.intersection(w)
        out = []
        for name, t, at, times in self.templates:
            need = self.min_coverage * len(t)
            if sum(n for x, n in times.items() if x in present) < need:
                continue
            places = [i for i, x in enumerate(w) if x in at]
            held = [w[p] for p in places]
            if sum(min(n, times[x]) for x, n in Counter(held).items()) < need:
                continue
            out += [(name, n / len(t), first, last + 1) for first, last, n in self._hits(held, places, t, at, need)]
        return out


def scan(docs: DataFrame, *, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per hit: doc_id, license, coverage, start_word, end_word, in text order per template."""
    chosen = TEMPLATES if templates is None else templates
    rows = text_rows(docs, id_col, text_col)
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("license", T.StringType()),
        T.StructField("coverage", T.DoubleType()), T.StructField("start_word", T.LongType()),
        T.StructField("end_word", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, min_coverage)
        for batch in batches:
            at, hits = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = scanner(text) if text else []
                at += [i] * len(found)
                hits += found
            columns = list(zip(*hits)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], pa.string()),
                 pa.array(columns[1], pa.float64()), *[pa.array(c, pa.int64()) for c in columns[2:]]],
                ["doc_id", "license", "coverage", "start_word", "end_word"])

    return rows.mapInArrow(run, schema)

"""License scans: MinHash bands over overlapping windows, then exact shingle containment."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pairloom.llm.arrow_rows import add_columns
from pairloom.llm.text_words import LETTERS_LOWER, Words, mix, ngrams, words_of

SHINGLE = 5
#: A window matches a template if it holds this share of the template's distinct shingles.
CONTAINMENT = 0.8
#: Chance that a matching window's grid neighbour shares a band with the template.
COLLISION = 0.999
ROWS = 2
#: Windows of a template of ``m`` words begin every ``m // STRIDES`` words.
STRIDES = 8

#: Short notices as publicly used with each license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("All-rights-reserved", "All rights reserved."),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    (
        "Apache-2.0-header",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "GPL-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "BSD-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
)


def bands_for(similarity: float, rows: int = ROWS, chance: float = COLLISION) -> int:
    """Bands of ``rows`` minima so that sets this similar share one with at least ``chance``."""
    if similarity >= 1:
        return 1
    return math.ceil(math.log(1 - chance) / math.log(1 - similarity**rows))


@dataclass(frozen=True)
class Template:
    name: str
    words: int
    size: int
    shingles: np.ndarray

    @property
    def stride(self) -> int:
        return max(1, self.words // STRIDES)

    @property
    def reach(self) -> int:
        """Shingles of a window."""
        return self.words - self.size + 1

    @property
    def bands(self) -> int:
        """From the least similarity of a matching window's nearest window on the grid."""
        n = len(self.shingles)
        shared = max(1, math.ceil(CONTAINMENT * n) - self.stride // 2)
        return bands_for(shared / (n + self.reach - shared))


def templates_of(texts=TEMPLATES) -> list[Template]:
    """Templates as shingle sets; one of fewer words than a shingle is a single shingle."""
    out = []
    for name, text in texts:
        words = words_of([text.encode()], LETTERS_LOWER)
        n = len(words.hash)
        if n:
            size = min(SHINGLE, n)
            out.append(Template(name, n, size, np.unique(ngrams(words, size)[1])))
    return out


def _factor(k: int) -> np.uint64:
    return mix(np.array([k + 1], dtype=np.uint64))[0] | np.uint64(1)


def _window_minima(value: np.ndarray, start: np.ndarray, length: np.ndarray, reach: int) -> np.ndarray:
    """Least value in each window; windows are ``reach`` long unless their document is shorter."""
    out = np.empty(len(start), dtype=np.uint64)
    full = length == reach
    power, span = value, 1
    while span * 2 <= reach:
        power = np.minimum(power[:-span], power[span:]) if len(power) > span else power[:0]
        span *= 2
    if full.any():
        at = start[full]
        out[full] = np.minimum(power[at], power[at + reach - span])
    if not full.all():
        few = np.flatnonzero(~full)
        pairs = np.stack([start[few], start[few] + length[few]], axis=1).ravel()
        out[few] = np.minimum.reduceat(np.append(value, np.uint64(2**64 - 1)), pairs)[::2]
    return out


def _grid(cuts: np.ndarray, template: Template) -> tuple[np.ndarray, np.ndarray]:
    """First shingle and length of the windows on the grid, the last window of a document too."""
    counts = np.diff(cuts)
    some = np.flatnonzero(counts > 0)
    last = np.maximum(counts[some] - template.reach, 0)
    steps = -(-last // template.stride) + 1
    at = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
    offset = np.minimum(at * template.stride, np.repeat(last, steps))
    start = np.repeat(cuts[some], steps) + offset
    length = np.minimum(template.reach, np.repeat(cuts[some + 1], steps) - start)
    return start, length


def _retrieved(value: np.ndarray, cuts: np.ndarray, group: list[Template]) -> list[np.ndarray]:
    """Grid windows that share a band with each template of one length."""
    lead = group[0]
    start, length = _grid(cuts, lead)
    found = [np.zeros(len(start), dtype=bool) for _ in group]
    for band in range(max(t.bands for t in group)):
        same = None
        for row in range(ROWS):
            factor = _factor(band * ROWS + row)
            low = _window_minima(value * factor, start, length, lead.reach)
            own = [low == (t.shingles * factor).min() for t in group]
            same = own if same is None else [a & b for a, b in zip(same, own)]
        for k, t in enumerate(group):
            if band < t.bands:
                found[k] |= same[k]
    return [start[f] for f in found]


def _verified(value: np.ndarray, low: int, high: int, starts: np.ndarray, t: Template) -> list[dict]:
    """Exact matches near retrieved windows of one document, as merged spans of words."""
    spans: list[list] = []
    last = max(high - t.reach, low)
    near = sorted({s for g in starts.tolist() for s in range(max(low, g - t.stride), min(last, g + t.stride) + 1)})
    for s in near:
        e = min(s + t.reach, high)
        held = len(np.intersect1d(value[s:e], t.shingles)) / len(t.shingles)
        if held < CONTAINMENT:
            continue
        begin, end = s - low, e - low + t.size - 1
        if spans and begin <= spans[-1][1]:
            spans[-1][1], spans[-1][2] = max(spans[-1][1], end), max(spans[-1][2], held)
        else:
            spans.append([begin, end, held])
    return [{"license": t.name, "start": a, "end": b, "containment": c} for a, b, c in spans]


def matches_of(texts: list[bytes | None], templates: list[Template]) -> list[list[dict]]:
    """Matches of each text, ordered by template and place."""
    words: Words = words_of(texts, LETTERS_LOWER)
    out: list[list[dict]] = [[] for _ in texts]
    by_size: dict[int, tuple] = {}
    for length in sorted({t.words for t in templates}):
        group = [t for t in templates if t.words == length]
        size = group[0].size
        if size not in by_size:
            at, value = ngrams(words, size)
            by_size[size] = value, np.searchsorted(at, words.first)
        value, cuts = by_size[size]
        for t, starts in zip(group, _retrieved(value, cuts, group)):
            doc = np.searchsorted(cuts, starts, side="right") - 1
            for d in np.unique(doc):
                out[d] += _verified(value, int(cuts[d]), int(cuts[d + 1]), starts[doc == d], t)
    return [sorted(m, key=lambda x: (x["license"], x["start"])) for m in out]


_MATCH = T.StructType([
    T.StructField("license", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("containment", T.DoubleType()),
])
_ARROW_MATCH = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())])


def find_licenses(docs: DataFrame, texts=TEMPLATES, carry=None) -> DataFrame:
    """``(row, matches)``: places of whole texts that hold a template's shingles.

    Words are runs of letters and digits in lower case. A window as long as a template (or its
    whole document, if shorter) matches if it holds 80 % of the template's distinct 5-word
    shingles; matching windows that overlap or touch are one match, in word positions with the
    end exclusive. Windows on a grid are retrieved by MinHash bands, set so that a matching
    window's nearest grid window is found with a chance of 99.9 % or more, and of 100 % for an
    exact copy of a template of up to 15 words; every window near a retrieved one is then
    compared exactly.

    Templates are a parameter and travel with the tasks; they are few by nature. Null and empty
    texts have no matches; repeated rows are judged alike; other columns ride along in ``row``.
    Nothing is shuffled.
    """
    templates = templates_of(texts)
    return add_columns(
        docs, lambda held: [matches_of(held, templates)], [("matches", T.ArrayType(_MATCH), pa.list_(_ARROW_MATCH))], carry
    )

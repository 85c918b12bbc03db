"""License scan by patience alignment of documents with license templates.

Words are runs of letters and digits, A-Z and accented capitals in lower case. A
stretch of a document is aligned with a template where enough of its words are the
template's: words that occur once in both are anchors, the longest increasing
subsequence of anchors is kept, and the gaps between them are aligned the same way;
equal words at the ends of a gap match too. The coverage is the share of the
template's words that are matched in order.

A stretch begins at a template word and is one and a quarter times as long as the
template. Stretches of coverage ``least`` or more are taken from left to right for each
template; where those of two templates overlap, the one with more matched words is
reported (then the higher coverage, then the first name). Words are compared by
64-bit hashes.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import text

# Notices by which documents declare a license.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software"
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
}

SCHEMA = "license string, coverage double, first_word bigint, last_word bigint"


def anchors(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Places of the words that occur once in ``a`` and once in ``b``, increasing in both."""
    in_a, in_b = Counter(a), Counter(b)
    place = {w: j for j, w in enumerate(b) if in_b[w] == 1}
    pairs = [(i, place[w]) for i, w in enumerate(a) if in_a[w] == 1 and w in place]
    tops: list[int] = []  # smallest last place in b of an increasing run of each length
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            ends.append(k)
        else:
            tops[at], ends[at] = j, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matched places, increasing in both, by patience alignment."""
    found, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        i, j = a0, b0
        chain = anchors(a[a0:a1], b[b0:b1])
        for x, y in chain:
            found.append((a0 + x, b0 + y))
            gaps.append((i, a0 + x, j, b0 + y))
            i, j = a0 + x + 1, b0 + y + 1
        if chain:
            gaps.append((i, a1, j, b1))
    return sorted(found)


def _codes(bodies: Sequence[str]) -> list[np.ndarray]:
    data, at = text.utf8(pa.array(bodies, pa.string()))
    low = text.fold_latin(data)
    starts, ends, first = text.words(low, at, text.ALNUM)
    return np.split(text.hashes(low, starts, ends), first[1:-1])


def reported(found: Iterable[tuple[int, str, float, int, int, int]]) -> list[tuple[int, str, float, int, int]]:
    """Of stretches that overlap in a row, the best; in order of row and place."""
    kept: dict[int, list[tuple[int, int]]] = {}
    out = []
    for row, name, coverage, begin, last, _ in sorted(found, key=lambda f: (-f[5], -f[2], f[1], f[3])):
        if all(last < b or begin > e for b, e in kept.setdefault(row, [])):
            kept[row].append((begin, last))
            out.append((row, name, coverage, begin, last))
    return sorted(out, key=lambda f: (f[0], f[3]))


def scan_piece(
    data: np.ndarray, at: np.ndarray, templates: Mapping[str, np.ndarray], least: float
) -> Iterator[tuple[int, str, float, int, int, int]]:
    """(row, license, coverage, first word, last word, words matched) of the stretches of each template."""
    low = text.fold_latin(data)
    starts, ends, first = text.words(low, at, text.ALNUM)
    codes = text.hashes(low, starts, ends)
    everything = np.unique(np.concatenate([*templates.values(), np.zeros(0, np.uint64)]))
    if not len(everything) or not len(codes):
        return
    place = np.searchsorted(everything, codes)
    place[place == len(everything)] = 0
    where = np.flatnonzero(everything[place] == codes)
    terms = place[where]
    row = text.rows_of(where, first)
    for name, template in templates.items():
        if not len(template):
            continue
        member = np.zeros(len(everything), bool)
        member[np.searchsorted(everything, template)] = True
        hit = member[terms]
        spots, rows = where[hit], row[hit]
        width = math.ceil(1.25 * len(template))
        # no stretch reaches the coverage with fewer of the template's words
        need = math.ceil(least * len(template) - 1e-9)
        limit = np.minimum(spots + width, first[rows + 1])
        enough = np.searchsorted(spots, limit) - np.arange(len(spots)) >= need
        own = template.tolist()
        free_from = 0
        for spot, r, end in zip(spots[enough].tolist(), rows[enough].tolist(), limit[enough].tolist()):
            if spot < free_from:
                continue
            matched = align(codes[spot:end].tolist(), own)
            coverage = len(matched) / len(own)
            if coverage >= least and matched[0][0] == 0:
                begin, last = spot, spot + matched[-1][0]
                yield r, name, coverage, begin - int(first[r]), last - int(first[r]), len(matched)
                free_from = last + 1


def scan(
    documents: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    least: float = 0.8,
    key: str = "doc_id",
    body: str = "text",
) -> DataFrame:
    """One row per found notice: ``key``, ``license``, ``coverage``, ``first_word`` and
    ``last_word`` (counted from 0 over the document's words).

    Null and empty texts have none. A pass without a shuffle; other columns are not
    read. Templates without words match nothing.
    """
    kind = documents.schema[key].dataType.simpleString()
    compiled = dict(zip(templates, _codes(list(templates.values()))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in text.pieces(batch.column(1)):
                found = reported(scan_piece(data, at, compiled, least))
                if found:
                    row, license_, coverage, begin, last = zip(*found)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": batch.column(0)[lo:hi].take(pa.array(row, pa.int64())),
                            "license": license_,
                            "coverage": coverage,
                            "first_word": begin,
                            "last_word": last,
                        }
                    )

    rows = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))
    return rows.mapInArrow(run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)

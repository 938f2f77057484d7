"""Operator 10: license scans by MinHash bands over overlapping text windows, verified by exact shingle containment.

Texts are words (runs of ASCII letters and digits and of non-ASCII bytes, lower case) and shingles of five words. A template of n
shingles is looked for in windows of 2L shingles that start every L shingles, L being the power of two from n on:
so a run of n shingles lies in one window whole. Each hash function is a band of its own. The number of
bands follows from the least similarity of a window that holds CONTAINMENT of a template, so that such a window is missed with a
probability of at most MISS. Windows that share a band with a template are compared with it word by word. A document of fewer shingles
than CONTAINMENT of a template has cannot hold it and has no windows of its size. Of places that overlap, the one with the most shingles names the license, if it holds the words that tell its template from those of other licenses.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import license_texts
from vulnlake.llm.arrays import as_bytes, ragged, slices
from vulnlake.llm.tables import pick

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6

# Public license notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("GPL-2.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
)
# Fixed value: the line that names a license, or an expression of several, by identifier.
SPDX = re.compile(rb"SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9][A-Za-z0-9.+:\-]*\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9][A-Za-z0-9.+:\-]*\)*)*)")
# Odd multipliers for hashing.
ROLL = 0x9E3779B97F4A7C15
CHAIN = 0xD6E8FEB86659FD93
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
CHUNK = 1 << 19
# Largest table of templates, in characters: it travels to every task.
MOST_TEXT = 32_000_000


def all_templates() -> tuple[tuple[str, str], ...]:
    """The short notices, and after them the full texts."""
    return TEMPLATES + license_texts.templates()


# ---- words and shingles ------------------------------------------------------------------------
@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, ROLL, np.uint64), np.full(n, pow(ROLL, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@cache
def _word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
    table[128:] = True
    return table


def words(lowered: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, hash) of every word."""
    data = np.frombuffer(lowered, np.uint8)
    inside = np.concatenate([[False], _word_bytes()[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers(max(1 << 20, 1 << len(data).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    value ^= value >> np.uint64(31)
    return starts, ends, value * np.uint64(CHAIN)


def chained(hashes: np.ndarray) -> np.ndarray:
    """Hash of the SHINGLE words from every place on."""
    n = max(0, len(hashes) - SHINGLE + 1)
    value = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        value = value * np.uint64(ROLL) + hashes[k : k + n]
    value ^= value >> np.uint64(32)
    return value * np.uint64(CHAIN)


def shingle_set(lowered: bytes) -> set[tuple[bytes, ...]]:
    own = WORD.findall(lowered)
    return {tuple(own[i : i + SHINGLE]) for i in range(len(own) - SHINGLE + 1)}


# ---- templates ---------------------------------------------------------------------------------
class Family:
    """The templates of one window size, and their bands."""

    def __init__(self, size: int, members: list[int], templates):
        self.size, self.members = size, members
        self.sets = [shingle_set(templates[t][1].lower().encode()) for t in members]
        least = min(math.ceil(CONTAINMENT * len(s)) / (2 * size + len(s) - math.ceil(CONTAINMENT * len(s))) for s in self.sets)
        self.fewest = min(math.ceil(CONTAINMENT * len(s)) for s in self.sets)
        self.bands = max(1, math.ceil(math.log(MISS) / math.log(1 - least)))
        own = [chained(words(templates[t][1].lower().encode())[2]) for t in members]
        self.least = np.array([[int(permuted(h, j).min()) for j in range(self.bands)] for h in own], np.uint32)


def permuted(hashes: np.ndarray, band: int) -> np.ndarray:
    """The hashes under the hash function of a band."""
    spread = np.uint64((CHAIN * (2 * band + 3) ** 5) % (1 << 64) | 1)
    return ((hashes ^ np.uint64(band * 0x9E3779B9)) * spread >> np.uint64(32)).astype(np.uint32)


@cache
def families(templates=TEMPLATES) -> list[Family]:
    by_size: dict[int, list[int]] = {}
    for t, (_, text) in enumerate(templates):
        n = len(shingle_set(text.lower().encode()))
        if n:
            by_size.setdefault(1 << (n - 1).bit_length(), []).append(t)
    return [Family(size, by_size[size], templates) for size in sorted(by_size)]


@cache
def distinguishing(templates=TEMPLATES) -> list[list[set]]:
    """Per template: for every template of another license that holds CONTAINMENT of it, the shingles that are not in that one."""
    sets = [shingle_set(text.lower().encode()) for _, text in templates]
    return [
        [own - other for u, other in enumerate(sets) if templates[u][0] != templates[t][0] and own and len(own & other) >= CONTAINMENT * len(own)]
        for t, own in enumerate(sets)
    ]


# ---- search ------------------------------------------------------------------------------------
def candidates(hashes: np.ndarray, bounds: np.ndarray, family: Family) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first shingle within it, member) of windows that share a band with a template.

    `bounds` are the documents' places in `hashes`. Blocks of `size` shingles are minimised once, windows are two of them.
    """
    counts = np.diff(bounds)
    blocks = -(-counts // family.size)
    of = np.repeat(np.arange(len(counts)), blocks)
    starts = ragged(np.zeros(len(blocks), np.int64), blocks) * family.size
    places = bounds[of] + starts
    more = np.flatnonzero(of[1:] == of[:-1])
    hit = np.zeros((len(family.members), len(places)), bool)
    for band in range(family.bands):
        value = permuted(hashes, band)
        low = np.minimum.reduceat(value, places) if family.size > 1 else value[places]
        low = low.copy()
        pair = np.minimum(low[more], low[more + 1])
        low[more] = pair
        for m in range(len(family.members)):
            hit[m] |= low == family.least[m, band]
    member, window = np.nonzero(hit)
    return of[window], starts[window], member


def matches(texts: list[bytes], templates=TEMPLATES) -> list[tuple[int, int, int, int, float]]:
    """(text, template, first byte, end, containment) of every place that holds a template."""
    return [place[:5] for place in places(texts, templates)]


def places(texts: list[bytes], templates=TEMPLATES) -> list[tuple[int, int, int, int, float, bool]]:
    """(text, template, first byte, end, containment, best) of every place that holds a template.

    Neighbouring windows that both hold it are one place: the better one counts, the first of equals.
    """
    lowered = [t.lower() for t in texts]
    joined = b"\0".join(lowered)
    starts, ends, value = words(joined)
    base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
    cut = np.searchsorted(starts, base)
    counts = np.maximum(np.diff(cut) - SHINGLE + 1, 0)
    if not counts.sum():
        return []
    every = chained(value)
    found = []
    for family in families(templates):
        able = np.flatnonzero(counts >= family.fewest)
        if not len(able):
            continue
        hashes = every[ragged(cut[able], counts[able])]
        doc, first, member = candidates(hashes, np.concatenate([[0], np.cumsum(counts[able])]), family)
        for d, s, m in zip(able[doc].tolist(), first.tolist(), member.tolist()):
            a, b = int(cut[d]) + s, min(int(cut[d]) + s + 2 * family.size + SHINGLE - 1, int(cut[d + 1]))
            own = [joined[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())]
            there = [i for i in range(len(own) - SHINGLE + 1) if tuple(own[i : i + SHINGLE]) in family.sets[m]]
            held = {tuple(own[i : i + SHINGLE]) for i in there}
            share = len(held) / len(family.sets[m])
            if share >= CONTAINMENT:
                span = int(starts[a + there[0]] - base[d]), int(ends[a + there[-1] + SHINGLE - 1] - base[d])
                told = all(not held.isdisjoint(only) for only in distinguishing(templates)[family.members[m]])
                found.append((d, family.members[m], s, *span, share, family.size, len(held), told))
    found.sort()
    out: list[tuple[int, int, int, int, float, int, bool]] = []
    at = None
    for d, t, s, x, y, share, size, n, told in found:
        if at == (d, t, s - size) and x < out[-1][3]:
            if share > out[-1][4]:
                out[-1] = (d, t, x, y, share, n, told)
        else:
            out.append((d, t, x, y, share, n, told))
        at = (d, t, s)
    best = _best(out)
    return [(*place[:5], i in best) for i, place in enumerate(out)]


def _best(found: list[tuple[int, int, int, int, float, int, bool]]) -> set[int]:
    """Of the places that tell their license, those that no better one overlaps: more shingles, then the larger share of the template."""
    taken: dict[int, list[tuple[int, int]]] = {}
    best = set()
    for i in sorted((i for i, p in enumerate(found) if p[6]), key=lambda i: (-found[i][5], -found[i][4], i)):
        d, _, x, y = found[i][:4]
        own = taken.setdefault(d, [])
        k = bisect_left(own, (y, 0))
        if not (k and own[k - 1][1] > x):
            own.insert(k, (x, y))
            best.add(i)
    return best


def checked(templates) -> tuple[tuple[str, str], ...]:
    """Pairs of license and text, from a table too; an error where there are too many, or where one has no shingle."""
    if isinstance(templates, DataFrame):
        own = templates.select("license", "text").dropna().distinct()
        size = own.agg(F.sum(F.length("license") + F.length("text"))).first()[0] or 0
        if size > MOST_TEXT:
            raise ValueError(f"templates of {size} characters, more than {MOST_TEXT}")
        templates = tuple((r[0], r[1]) for r in own.orderBy("license", "text").collect())
    short = [name for name, text in templates if len(WORD.findall(text.lower().encode())) < SHINGLE]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    return tuple(templates)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None) -> DataFrame:
    """doc_id, license, template, start, end, containment, best: one row per place of a document's text that holds a template.

    `template` is its number; start and end are bytes of the UTF-8 text. `best` is true where the row names the license of its place:
    it holds the words that tell it from similar licenses, and no better place overlaps it. A line SPDX-License-Identifier is a
    row too, without a template and with its expression as license. `templates` are pairs of license and text, or a table with these
    columns, numbered in their order; without them, the notices and the full texts. Templates of fewer than SHINGLE words and tables beyond
    MOST_TEXT raise an error. Null and short texts have no rows, repeated rows repeat theirs. Texts are read whole, and the
    work is done where they are: nothing is shuffled.
    """
    templates = checked(all_templates() if templates is None else templates)
    own = pick(docs, doc_id, text).toDF("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for i, j in slices([len(t) for t in texts], CHUNK):
                rows = [(d, templates[t][0], t, x, y, share, best) for d, t, x, y, share, best in places(texts[i:j], templates)]
                for d, own_text in enumerate(texts[i:j]):
                    for m in SPDX.finditer(own_text):
                        name = m[1].decode().rstrip(".:")
                        rows.append((d, name, None, m.start(), m.start(1) + len(name), 1.0, True))
                if rows:
                    d, names, t, x, y, share, best = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i).take(pa.array(d)), pa.array(names, pa.string()), pa.array(t, pa.int32()),
                         pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(share, pa.float64()), pa.array(best, pa.bool_())],
                        names=["doc_id", "license", "template", "start", "end", "containment", "best"],
                    )

    return own.mapInArrow(run, f"doc_id {kind}, license string, template int, start bigint, `end` bigint, containment double, best boolean")

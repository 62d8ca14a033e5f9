"""License texts in documents: winnowed fingerprints pick candidates, alignment confirms them.

Templates are cut into word k-grams, of which winnowing keeps the least hash of each window; an
inverted index holds where each kept k-gram stands in which template. A document's k-grams are
looked up there. Each diagonal of a template that has hits is a candidate, and an alignment of words
in a band around it gives the share of the template that the document matches and where.
"""

import bisect
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# Wordings of the usual notices and of the lines that name a licence. Whole licence
# texts lie in license_texts.
NOTICES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0",
    "MIT line": "Released under the MIT License",
    "BSD line": "Released under the BSD License",
    "ISC line": "Released under the ISC License",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "MIT opening": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so""",
    "BSD opening": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer.""",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
        of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/""",
    "GPL-2.0-only opening": """This program is free software; you can redistribute it and/or modify it under the terms of
        version 2 of the GNU General Public License as published by the Free Software Foundation""",
}
NOTICES["Apache-2.0 opening"] = NOTICES["Apache-2.0 notice"].partition(" See the License")[0]
for _version in ("2", "3"):
    NOTICES[f"GPL-{_version}.0 line"] = f"This work is licensed under the GNU General Public License, version {_version}"
_OPENING = """This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU
    {kind}General Public License as published by the Free Software Foundation, either version {version} of the
    License, or (at your option) any later version."""
_REST = """ This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
    implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public
    License for more details."""
for _name, _thing, _kind, _version in (
    ("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"), ("LGPL-2.0", "library", "Library ", "2"),
    ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "program", "Lesser ", "3"), ("AGPL-3.0", "program", "Affero ", "3"),
):
    _of = {"thing": _thing, "kind": _kind, "version": _version}
    NOTICES[f"{_name}-or-later opening"] = _OPENING.format(**_of)
    NOTICES[f"{_name}-or-later notice"] = (_OPENING + _REST).format(**_of)
for _version in ("3.0", "4.0"):
    for _code, _words in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ):
        NOTICES[f"CC-{_code}-{_version} line"] = f"Licensed under CC {_code} {_version}"
        _area = "International" if _version == "4.0" else "Unported"
        NOTICES[f"CC-{_code}-{_version} notice"] = (
            f"This work is licensed under a Creative Commons {_words} {_version} {_area} License"
        )
TEXTS = {path.stem: path.read_text("utf-8") for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
TEMPLATES = {**NOTICES, **{name: text.strip().rstrip(".") for name, text in TEXTS.items()}}
K = 3
WINDOW = 2
BAND = 8
MIN_COVERAGE = 0.8
#: Words of a template that are counted together when bounding what can match.
PART = 64
#: Diagonals that are bounded together first, and up to how many each is bounded by itself.
STRETCH = 64
FEW = 8
MATCH_SCHEMA = "doc_id long, license string, start long, end long, coverage double, matched int"

_WORDS = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words_of(text):
    """(word in small letters, start, end)."""
    return [(m.group().lower(), m.start(), m.end()) for m in _WORDS.finditer(text)]


def winnow(words, k=K, window=WINDOW):
    """Places of the k-grams kept: the least hash of each window, the last one on ties."""
    hashes = [zlib.crc32(" ".join(words[i : i + k]).encode()) for i in range(max(0, len(words) - k + 1))]
    kept = set()
    for start in range(max(1, len(hashes) - window + 1)):
        part = hashes[start : start + window]
        if part:
            kept.add(start + max(i for i, h in enumerate(part) if h == min(part)))
    return sorted(kept)


class TemplateIndex:
    """k-gram -> (template, place); and the first words of k-grams, which most words are not."""

    def __init__(self, templates):
        self.words = {name: [w for w, _, _ in words_of(text)] for name, text in templates.items()}
        self.parts = {
            name: [(at, len(words[at : at + PART]), Counter(words[at : at + PART])) for at in range(0, len(words), PART)]
            for name, words in self.words.items()
        }
        self.grams = defaultdict(list)
        for name, words in self.words.items():
            if len(words) < K:
                raise ValueError(f"a template needs {K} words: {name}")
            for at in winnow(words):
                self.grams[tuple(words[at : at + K])].append((name, at))
        self.vocabulary = {word for words in self.words.values() for word in words}
        self.firsts = {gram[0] for gram in self.grams}

    def may_hold(self, text):
        """Whether the text has any indexed k-gram."""
        words = [word.lower() for word in _WORDS.findall(text)]
        return not self.grams.keys().isdisjoint(zip(*[words[k:] for k in range(K)]))


def align(template, document, band):
    """Longest common subsequence of words with |i - j| at most `band`: [(i, j)].

    `document` is the stretch that the candidate's diagonal lays against the template."""
    n, width = len(template), 2 * band + 1
    best = [[0] * (width + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for d in range(width - 1, -1, -1):
            j = i + d - band
            if not 0 <= j < len(document):
                row[d] = row[d + 1] if j < 0 else 0
                continue
            if template[i] == document[j]:
                row[d] = below[d] + 1
            else:
                row[d] = max(below[d - 1] if d else 0, row[d + 1])
    pairs, i, d = [], 0, band
    d = max(range(width), key=lambda x: best[0][x]) if n else band
    while i < n and 0 <= d < width:
        j = i + d - band
        if j >= len(document):
            break
        if j >= 0 and template[i] == document[j] and best[i][d] == best[i + 1][d] + 1:
            pairs.append((i, j))
            i += 1
        elif best[i][d] == best[i][d + 1]:
            d += 1
        elif d and best[i][d] == best[i + 1][d - 1]:
            i, d = i + 1, d - 1
        else:
            break
    return pairs


def can_match(parts, words, offset, need, band):
    """False if no alignment around the diagonal can match `need` words: each part of the template
    matches at most the words that it has in common with the stretch in its reach."""
    spare = sum(length for _, length, _ in parts) - need
    for start, length, counts in parts:
        here = Counter(words[max(0, offset + start - band) : max(0, offset + start + length + band)])
        spare -= length - sum(min(n, here[word]) for word, n in counts.items())
        if spare < 0:
            return False
    return True


def within_bound(parts, places, offsets, need, band, more=0):
    """Which of many diagonals pass the bound of `can_match`, each taken together with the `more`
    diagonals after it. `places` has the sorted places of every word of the document.

    A part at a time, for the diagonals that can still match."""
    alive = np.arange(len(offsets))
    spare = np.full(len(offsets), sum(length for _, length, _ in parts) - need)
    for start, length, counts in parts:
        low = offsets[alive] + start - band
        high = low + length + 2 * band + more
        common = np.zeros(len(alive), np.int64)
        for word, n in counts.items():
            at = places.get(word)
            if at is not None:
                common += np.minimum(np.searchsorted(at, high) - np.searchsorted(at, low), n)
        spare[alive] -= length - common
        alive = alive[spare[alive] >= 0]
        if not len(alive):
            break
    return alive


def candidates(index, name, words, places, offsets, need, band):
    """The diagonals of a template's hits that the bounds leave."""
    size = len(index.words[name])
    offsets = [o for o in offsets if min(len(words), o + size + band) - max(0, o - band) >= need]
    if len(offsets) <= FEW:
        return offsets
    parts, found = index.parts[name], np.array(sorted(offsets))
    # whole stretches of diagonals first
    stretch = found // STRETCH
    first = np.unique(stretch)
    left = first[within_bound(parts, places, first * STRETCH, need, band, STRETCH - 1)]
    found = found[np.isin(stretch, left)]
    return found[within_bound(parts, places, found, need, band)].tolist()


def align_at(template, words, offset, band, hidden=()):
    """(place in the template, in the document) of the words matched around a diagonal; the words
    at `hidden` places don't match."""
    low, high = offset - band, min(len(words), offset + len(template) + band)
    stretch = [None if at < 0 or at in hidden else words[at] for at in range(low, high)]
    return [(i - band, j + low) for i, j in align([""] * band + template, stretch, band)]


def find_licenses(text, index, band=BAND, least=MIN_COVERAGE):
    """(license, start, end in code points, coverage, words matched), by place.

    Every diagonal that has a hit and may reach `least` is aligned. Of matches over the same words
    the one with most words matched counts, then the one that covers more of its template."""
    if not index.may_hold(text):
        return []
    found = words_of(text)
    words = [w for w, _, _ in found]
    diagonals = defaultdict(lambda: defaultdict(list))
    for at, word in enumerate(words):
        if word in index.firsts:
            for name, place in index.grams.get(tuple(words[at : at + K]), ()):
                diagonals[name][at - place].append(at)
    places = defaultdict(list)
    for at, word in enumerate(words):
        places[word].append(at)
    places = {word: np.array(at) for word, at in places.items() if word in index.vocabulary}
    matches = []
    for name, offsets in diagonals.items():
        template, covered = index.words[name], {}
        need = max(1, math.ceil(least * len(template) - 1e-9))
        offsets = {o: offsets[o] for o in candidates(index, name, words, places, offsets, need, band)}
        # the diagonals with most hits first: what they give spares others
        for offset, hits in sorted(offsets.items(), key=lambda o: (-len(o[1]), o[0])):
            final, n = covered.get(hits[0], (-1, 0))
            more = max(need, n + 1) if hits[-1] <= final else need
            if not can_match(index.parts[name], words, offset, more, band):
                continue
            pairs = align_at(template, words, offset, band)
            while len(pairs) >= need:
                first, final = pairs[0][1], pairs[-1][1]
                coverage = len(pairs) / len(template)
                matches.append((found[first][1], found[final][2], name, coverage, len(pairs)))
                covered.update(dict.fromkeys(range(first, final + 1), (final, len(pairs))))
                # what is left beside the matches so far
                pairs = align_at(template, words, offset, band, covered)
    matches.sort(key=lambda m: (-m[4], -m[3], m[0], m[2]))
    chosen = []
    for match in matches:
        at = bisect.bisect_left(chosen, match)
        if (at == 0 or chosen[at - 1][1] <= match[0]) and (at == len(chosen) or match[1] <= chosen[at][0]):
            chosen.insert(at, match)
    return [(name, start, end, coverage, n) for start, end, name, coverage, n in chosen]


def scan_licenses(docs, templates=None, id_col="doc_id", text_col="text", band=BAND, least=MIN_COVERAGE):
    """One row per match: doc_id, license, start, end (code points), coverage, matched words.

    Null and empty texts and documents without a match give no row; repeated rows are scanned each.
    Whole texts are read. The templates are the only thing that every task holds."""
    templates = dict(TEMPLATES if templates is None else templates)

    def scan(batches):
        index = TemplateIndex(templates)
        for batch in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for match in find_licenses(text, index, band, least)
            ]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "license", "start", "end", "coverage", "matched"],
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(scan, MATCH_SCHEMA)

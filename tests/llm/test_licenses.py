"""Licence matches that lie close together, and the shipped texts."""

import math
import random
import time

import numpy as np

from logweir.llm import licenses


def found_in(text):
    return [(name, text[start:end]) for name, start, end, _, _ in licenses.find_licenses(text, licenses.TemplateIndex(licenses.TEMPLATES))]


def test_repeated_short_notices_are_all_found():
    for name in ("MIT line", "CC-BY-NC-4.0 line", "Apache-2.0 line", "GPL-3.0 line"):
        notice = licenses.TEMPLATES[name]
        for n in (2, 3, 7):
            assert found_in(". ".join([notice] * n) + ".") == [(name, notice)] * n


def test_a_heading_does_not_hide_the_line_below():
    line = "Licensed under the Apache License, Version 2.0"
    assert found_in("Apache License, Version 2.0\n" + line) == [("Apache-2.0 line", line)]


def test_words_added_near_the_start_keep_the_start():
    words = licenses.TEMPLATES["MIT"].split()
    text = " ".join(words[:2] + ["most"] + words[2:])
    assert found_in(text) == [("MIT", text)]


def test_whole_texts_and_versions_are_told_apart():
    index = licenses.TemplateIndex(licenses.TEMPLATES)
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"} <= set(licenses.TEXTS)
    for name, text in licenses.TEMPLATES.items():
        got = [(n, c) for n, _, _, c, _ in licenses.find_licenses("Some words first. " + text + ". And some after.", index)]
        assert got == [(name, 1.0)]
    edited = licenses.TEXTS["ISC"].replace("AUTHOR", "COPYRIGHT HOLDER")
    assert [m[0] for m in licenses.find_licenses(edited, index)] == ["ISC"]


def test_candidates_miss_nothing_that_exhaustive_alignment_finds():
    """Every diagonal of every template aligned, for matches with four words running: winnowing
    promises a hit in those."""
    rnd = random.Random(8)
    templates = {name: text for name, text in licenses.NOTICES.items() if len(text.split()) < 40}
    index, found, wanted = licenses.TemplateIndex(templates), 0, 0
    for _ in range(60):
        words = []
        for _ in range(2):
            notice = rnd.choice(list(templates.values())).split()
            for _ in range(rnd.randint(0, len(notice) // 4)):
                notice[rnd.randrange(len(notice))] = rnd.choice(["other", "the", "License", "2.0"])
            words += ["filler"] * rnd.randint(0, 4) + notice
        text = " ".join(words)
        document = [w for w, _, _ in licenses.words_of(text)]
        got = licenses.find_licenses(text, index)
        spans = [(start, end) for _, start, end, _, _ in got]
        places = [(start, end) for _, start, end in licenses.words_of(text)]
        for name, template in index.words.items():
            need = max(1, math.ceil(licenses.MIN_COVERAGE * len(template) - 1e-9))
            for offset in range(-len(template), len(document) + 1):
                pairs = licenses.align_at(template, document, offset, licenses.BAND)
                runs = [k for k in range(len(pairs) - 3) if all(pairs[k + d] == (pairs[k][0] + d, pairs[k][1] + d) for d in range(4))]
                if len(pairs) < need or not runs:
                    continue
                wanted += 1
                start, end = places[pairs[0][1]][0], places[pairs[-1][1]][1]
                found += any(a < end and start < b for a, b in spans)
    assert wanted > 200 and found == wanted


def test_bounds_drop_no_diagonal_that_can_match():
    rnd = random.Random(9)
    template = [rnd.choice("abcdefghij") for _ in range(150)]
    index = licenses.TemplateIndex({"t": " ".join(template)})
    for _ in range(20):
        words = [rnd.choice("abcdefghijxyz") for _ in range(400)]
        at = rnd.randint(0, 250)
        words[at : at + 150] = [w if rnd.random() < 0.85 else "x" for w in template]
        places = {w: np.flatnonzero(np.array(words) == w) for w in set(words)}
        offsets, need = range(-100, 390), rnd.choice([110, 120, 130])
        left = licenses.candidates(index, "t", words, places, offsets, need, 8)
        want = [
            o for o in offsets
            if min(len(words), o + 158) - max(0, o - 8) >= need and licenses.can_match(index.parts["t"], words, o, need, 8)
        ]
        assert left == want


def test_long_texts_without_a_match_are_quick():
    rnd = random.Random(3)
    pieces = []
    for text in licenses.TEXTS.values():
        words = text.split()
        pieces += [" ".join(words[i : i + rnd.randint(4, 9)]) for i in range(0, len(words) - 12, 7)]
    text = " ".join(rnd.choice(pieces) for _ in range(5200))
    assert len(text) > 200_000
    index = licenses.TemplateIndex(licenses.TEMPLATES)
    start = time.process_time()
    assert licenses.find_licenses(text, index) == []
    assert time.process_time() - start < 2
    whole = licenses.TEXTS["MIT"].strip()
    found = licenses.find_licenses(text + " " + whole, index)
    assert [m[0] for m in found] == ["MIT"] and found[0][2] == len(text) + 1 + len(whole.rstrip("."))

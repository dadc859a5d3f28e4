"""Random access to codes; license rules against a plain reading of their law; long texts."""

import random
import re
import time

import numpy as np
import pytest

from quayside.llm import binary, licenses
from quayside.llm.signatures import SIGNATURES


@pytest.mark.parametrize("largest", [1, 255, 256, 65_535, 65_536, 2**24 + 5, 2**32 - 1])
def test_any_id_can_be_read_alone(largest):
    r = np.random.Generator(np.random.PCG64(largest))
    for n in (1, 7, 511, 512, 513, 20_000):
        # mostly small ids, some of every number of levels
        ids = (r.integers(0, 2**32, n, np.uint64) >> r.integers(0, 33, n, np.uint64)) % np.uint64(largest + 1)
        ids = ids.astype(np.uint32)
        codes = binary.Codes(binary.encode(ids))
        assert len(codes) == n and (codes.run(0, n) == ids).all()
        for places in (r.integers(0, n, 50), np.array([0, n - 1]), np.array([n // 2]), np.arange(n)[::-7], np.zeros(0, np.int64)):
            assert (codes.take(places) == ids[places]).all()


def test_one_two_and_three_levels():
    ids = np.array([0, 255, 256, 65_535, 65_536, 2**24 - 1, 2**24, 2**32 - 1, 5], np.uint32)
    codes = binary.Codes(binary.encode(ids))
    assert [len(chunk) for *_, chunk in codes.levels] == [9, 6, 4, 2]
    assert [int(codes.take(np.array([k]))[0]) for k in range(9)] == ids.tolist()
    with pytest.raises(ValueError):
        binary.Codes(b"none at all")


def test_a_run_is_read_without_looking_up_its_places(monkeypatch):
    rng = np.random.default_rng(5)
    ids = (rng.integers(0, 1 << 30, 5000) >> rng.integers(0, 30, 5000)).astype(np.uint32)
    codes = binary.Codes(binary.encode(ids))
    spans = [(0, 0), (0, 1), (511, 513), (4999, 5000), (5000, 5000), *np.sort(rng.integers(0, 5001, (300, 2)), 1).tolist()]
    looked_up = [codes.take(np.arange(a, b)) for a, b in spans]
    monkeypatch.setattr(binary.Codes, "take", None)
    for (a, b), want in zip(spans, looked_up, strict=True):
        assert (codes.run(a, b) == ids[a:b]).all() and (want == ids[a:b]).all() and len(want) == b - a
    assert len(binary.Codes(binary.encode(ids[:0])).run(0, 0)) == 0


def plain_detections(text):
    """The law as it is stated: highest priority first, what lies within words already taken is dropped."""
    words = text.encode().translate(licenses._TABLE).split()
    whole, found, kept = b" " + b" ".join(words) + b" ", [], []
    for label, phrase in ((x, p) for p, x in licenses.BASE):
        own = phrase.encode().split()
        found += [(label, k, k + len(own) - 1, 1.0, True) for k in range(len(words)) if words[k : k + len(own)] == own]
    for rule in licenses.rules():
        for m in rule.pattern.finditer(whole):
            if not any(a <= m.start() and m.end() <= b for a, b in kept):
                kept.append(m.span())
                first = whole.count(b" ", 0, m.start()) - 1
                found.append((rule.label, first, first + m[0].count(b" "), rule.score, False))
    return len(words), sorted(found, key=lambda d: (d[1], -d[2], d[0]))


NOTICES = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "GNU General Public License version 2 or any later version", "GNU General Public License", "under the MIT license", "MIT license",
    "SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", "creative commons attribution non commercial share alike 4.0",
    "CC BY-NC-SA 4.0", "cc by nc", "all rights reserved", "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that", "released into the public domain", "this is free and unencumbered software released into the public domain",
    "bsd 3 clause license", "Mozilla Public License, v. 2.0", "LGPL 2.1", "gplv3", "provided as is without warranty of any kind", "zlib licensed",
]


def test_priority_and_containment_against_the_stated_law():
    r = random.Random(9)
    filler = "some words of a text that licenses nothing version 2 or later the license".split()
    for _ in range(60):
        parts = []
        for _ in range(r.randint(1, 25)):
            parts.append(r.choice(NOTICES) if r.random() < 0.5 else " ".join(r.choice(filler) for _ in range(r.randint(0, 6))))
        text = r.choice([" ", ", ", "\n"]).join(parts)
        assert licenses.detections(text) == plain_detections(text)


def test_a_detection_within_another_is_dropped_and_a_longer_one_is_not():
    # "mit license" lies within the longer phrase; two that only overlap both stay
    _, found = licenses.detections("released under the terms of the mit license")
    assert [(d[0], d[1], d[2]) for d in found if not d[4]] == [("mit", 0, 7)]


def test_very_long_texts_take_time_in_proportion():
    took = []
    notice = "This file is under the MIT license. " + NOTICES[0] + ". All rights reserved. "
    for copies in (500, 4000):
        start = time.perf_counter()
        n, found = licenses.detections(notice * copies)
        took.append(time.perf_counter() - start)
        assert sum(d[4] for d in found) == 2 * copies
    assert took[1] < 30 * took[0] + 2  # eight times the text


def expanded(expression):
    """All readings of an expression with plain alternatives."""
    m = re.search(r"\(\?:([^()]*)\)", expression)
    if m is None:
        return [expression]
    return [way for part in m[1].split("|") for way in expanded(expression[: m.start()] + part + expression[m.end() :])]


def test_signatures_are_gated_and_match_themselves():
    count = 0
    for label, score, priority, pairs in SIGNATURES:
        assert 0 < score <= 1 and 0 < priority < 100
        for keyword, expression in pairs:
            count += 1
            # what stays when all that is optional goes holds the keyword, whichever way it is read
            least = re.sub(r"\(\?[:!](?:[^()]|\([^()]*\))*\)\?|\(\?![^()]*\)", "", expression).replace(" ?", " ")
            ways = [least] if "(?:" not in least else expanded(least)
            assert all(keyword in way for way in ways), (label, keyword, ways)
    assert count >= 200
    rules = licenses.rules()
    assert len({(r.label, r.pattern.pattern) for r in rules}) == len(rules)
    for text, label in (
        ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE", "isc"),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
        ("Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software", "zlib"),
        ("It may be distributed under the same terms as Perl itself.", "perl"),
        ("This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit", "openssl"),
        ("https://creativecommons.org/licenses/by-nc-nd/4.0/", "cc-by-nc-nd"),
        ("https://www.boost.org/LICENSE_1_0.txt", "boost-1"),
        ("The Software shall be used for Good, not Evil.", "json"),
    ):
        assert label in {d[0] for d in licenses.detections(text)[1]}, text


def test_ordinary_text_has_no_labels():
    for text in ("The committee granted permission to speak.", "He had a license to fish and a copy of the book.",
                 "Copyright law is taught in the second year.", "public transport in the domain of cities"):
        assert licenses.detections(text)[1] == [], text
